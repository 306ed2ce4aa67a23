"""The operators over their whole tables, as registered queries, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversation_repair,
    fill_in_middle,
    flow_mix,
    impact_topk,
    language_id,
    license_scan,
    line_windows,
    quality_model,
    rules,
    sentence_spans,
    simhash,
    virtual_slots,
)
from .common import WORD, id_remainder, numbered, table, workspace

TOKENIZER = "word_bpe_49k.json"
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    return language_id.train(docs.where(id_remainder("doc_id", 4) != 2))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_model(docs), keep=["doc_id"])
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    labels = labels.where(id_remainder("doc_id", 5) != 0).select("doc_id", "quality").distinct()
    weights = quality_model.train(docs.select("doc_id", "text").join(labels, "doc_id"), workspace(spark))
    found = quality_model.predict(docs, weights, keep=["doc_id"])
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = virtual_slots.shard(table(spark, sf_dir, "documents"), workspace(spark))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def mix_by_source(docs: DataFrame, stage) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs``: id, version, source, size, copies, taken; and source, source_size, target."""
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("version"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("doc_id", "text", F.lit("mix")).alias("order"),
    )
    # Copies of a row get orders of their own, so that they spread over the buckets.
    order = F.when(F.col("copy") == 0, F.col("order")).otherwise(F.xxhash64("order", "copy"))
    sized = numbered(rows).select("id", "version", "source", "size", order.alias("order"), F.array("source").alias("members"))
    sized = stage.table(sized, "mix_sizes")
    sizes = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    targets = flow_mix.water_fill(sizes, WEIGHTS, SHARE, MOST)
    taken = flow_mix.mix(sized, {s: int(t + 0.5) for s, t in targets.items()}, stage, passes=int(MOST)).taken
    by_source = docs.sparkSession.createDataFrame(
        [(s, sizes[s], float(targets[s])) for s in sizes], "source string, source_size long, target double"
    )
    return taken, by_source


def op4_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, by_source = mix_by_source(table(spark, sf_dir, "documents"), workspace(spark))
    joined = taken.join(by_source, taken["source"].eqNullSafe(by_source["source"]))
    return joined.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_windows.dedup_lines(docs, stage=workspace(spark)).select("doc_id", "text", "n_lines", "n_removed")


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.dedup_sentences(docs, stage=workspace(spark)).select("doc_id", "text", "n_sentences", "n_removed")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, workspace(spark))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), workspace(spark))
    return found.select("doc_id", "fingerprint", "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(public_tokenizers.path(TOKENIZER))
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary)


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """``turns`` with planted faults, and which rows are to count as dropped."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        kind.alias("kind"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows, F.col("kind") == 0


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, dropped = damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit(turns, workspace(spark), absent=dropped)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"), workspace(spark))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fill_in_middle.restore("output", "form")).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_quality_model, op3_virtual_slots, op4_flow_mix, op5_line_windows, op6_sentence_spans,
        op7_quality_rules, op8_impact_topk, op9_simhash, op10_bpe, op11_conversation_repair,
        op12_license_scan, op13_fill_in_middle,
    )
}

_WORD = r"'[^\x20\x09-\x0D]+'"


def _repeats_sql(units: str, normal: str, most: int, length: str, glue: str, count: str) -> str:
    """``length``: units of the run that starts with the first of ``ns``, ``most`` at most, with word counts ``ws``."""
    covered = " or ".join(f"coalesce(lag(later, {j}) over w and lag(length, {j}) over w > {j}, false)" for j in range(most))
    return f"""
with docs as materialized (select doc_id, text, {units} as u from documents),
 parts as materialized (select doc_id, unnest(u) as unit, generate_subscripts(u, 1) as place from docs),
 plain as (select doc_id, place, n, len(string_split(n, ' ')) as words from (select doc_id, place, {normal} as n from parts)),
 ahead as (
  select doc_id, place, list(n) over w as ns, list(words) over w as ws
  from plain window w as (partition by doc_id order by place rows between current row and {most - 1} following)),
 runs as (select doc_id, place, length, ns[1:length] as run from (select *, {length} as length from ahead)),
 marked as (
  select doc_id, place, length, length is not null and row_number() over (partition by length, run order by doc_id, place) > 1 as later from runs),
 covered as (select doc_id, place, {covered} as gone from marked window w as (partition by doc_id order by place)),
 kept as (
  select p.doc_id, count(*) filter (gone) as n_removed, string_agg(unit, '{glue}' order by p.place) filter (not gone) as text
  from parts p join covered c on p.doc_id = c.doc_id and p.place = c.place group by p.doc_id)
select d.doc_id, case when coalesce(n_removed, 0) = 0 then d.text else coalesce(k.text, '') end as text,
 coalesce(len(u), 0)::bigint as {count}, coalesce(n_removed, 0)::bigint as n_removed
from docs d left join kept k on d.doc_id = k.doc_id"""


def _rules_sql() -> str:
    words = ", ".join(f"'{w}'" for w in dict.fromkeys(rules.STOP_WORDS))
    verdict = []
    for r in rules.THRESHOLDS:
        bounds = [f"{r.measure} >= {r.least}"] * (r.least is not None) + [f"{r.measure} <= {r.most}"] * (r.most is not None)
        verdict.append(f"(n_words < {r.min_words} or ({' and '.join(bounds)}))")
    symbols = "".join(rules.SYMBOLS)
    return rf"""
with docs as materialized (
 select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {_WORD}) as words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_WORD})) as lines from documents),
 placed as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as place from docs),
 runs as (
  select doc_id, place, lead(word, 4) over w is not null as whole,
   word || ' ' || lead(word, 1) over w || ' ' || lead(word, 2) over w || ' ' || lead(word, 3) over w || ' ' || lead(word, 4) over w as run
  from placed window w as (partition by doc_id order by place)),
 twice as (select doc_id, place, whole and count(*) over (partition by doc_id, run) > 1 as twice from runs),
 covered as (
  select doc_id, twice or coalesce(lag(twice, 1) over w, false) or coalesce(lag(twice, 2) over w, false)
   or coalesce(lag(twice, 3) over w, false) or coalesce(lag(twice, 4) over w, false) as covered
  from twice window w as (partition by doc_id order by place)),
 repeated as (select doc_id, count(*) filter (covered) as n from covered group by doc_id),
 measured as (
  select d.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
   (length(text) - length(translate(text, '{symbols}', '')))::bigint as n_symbols,
   len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
   coalesce(r.n, 0)::bigint as n_repeat_words,
   len(list_filter(words, lambda w: lower(w) in ({words}))) as n_stop_words, len(list_filter(words, lambda w: w like '%!!')) as n_bang_words
  from docs d left join repeated r on d.doc_id = r.doc_id),
 ratios as (
  select *, case when n_words > 0 then word_chars / n_words else 0 end as chars_per_word,
   case when n_words > 0 then n_symbols / n_words else 0 end as symbols_per_word,
   case when n_words > 0 then n_stop_words / n_words else 0 end as stop_word_ratio,
   case when n_words > 0 then n_bang_words / n_words else 0 end as bang_word_ratio,
   case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio,
   n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not base_failed and {' and '.join(verdict)} as kept
from ratios"""


def _repair_sql() -> str:
    """The four states' cheapest edits, row by row; a state is a struct of cost, edits and text, compared in this order."""
    way = lambda cost, edits, body: f"{{'c': {cost}, 'e': {edits}, 'x': {body}}}"
    start = lambda z: f"case when {z}.x = '' then '' else {z}.x || chr(10) end"
    least = lambda *ways: f"list_min([{', '.join(ways)}])"
    delete = lambda z: way(f"{z}.c + 3", f"{z}.e || 'D'", f"{z}.x")

    def kept(z: str, initial: str) -> str:
        may = f"initial = '{initial}' and fault not in (1, 2)"
        return way(f"case when {may} then {z}.c + cut else 1000000000 end", f"{z}.e || 'K'", f"{start(z)} || role || ':' || text")

    def rerole(z: str, role: str) -> str:
        cost = f"case when fault not in (1, 2) then {z}.c + 2 + cut else 1000000000 end"
        return way(cost, f"{z}.e || 'R'", f"{start(z)} || '{role}:' || text")

    insert = lambda z, role: way(f"{z}.c + 2", f"{z}.e || 'I'", f"{start(z)} || '{role}:'")
    never = way("1000000000::bigint", "''", "''")
    begun = way("0::bigint", "''", "''")
    users = [f(z, x) for z in "sya" for f, x in ((kept, "u"), (rerole, "user"))]
    settled = f"""
 select conv_id, i, s, y, {least("u", insert("s", "user"), insert("y", "user"), insert("a", "user"))} as u, a from"""
    closed = f"select conv_id, i, s, y, u, {least('a', insert('u', 'assistant'))} as a from"
    return rf"""
with recursive polynomial(entries) as (
 select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n))),
 hashed as (
  select *, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint) as bytes
  from conversations),
 named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
   xor(list_reduce(bytes, lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 20 as kind
  from hashed, polynomial),
 rows as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
   case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from named where kind <> 0),
 placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
   row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as seen from rows),
 faulty as materialized (
  select *, left(role, 1) as initial, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when seen then 2
   when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 3 else 0 end as fault from placed),
 counted as (
  select conv_id, case when max(turn) is null then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end as gaps,
   count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated, count(*) as n
  from faulty group by conv_id),
 pairs as (
  select conv_id, lag(initial) over (partition by conv_id order by i) || initial as pair from faulty),
 illegal as (select conv_id, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from pairs group by conv_id),
 ids as (select distinct conv_id from conversations),
 walk as (
  {closed} ({settled} (select conv_id, 0::bigint as i, {begun} as s, {never} as y, {never} as u, {never} as a from ids))
  union all
  {closed} ({settled} (
   select w.conv_id, w.i + 1 as i, {delete("s")} as s, {least(delete("y"), kept("s", "s"))} as y,
    {least(delete("u"), *users)} as u, {least(delete("a"), kept("u", "a"), rerole("u", "assistant"))} as a
   from walk w join (select *, case when fault = 3 then 1 else 0 end as cut from faulty) f
    on w.conv_id is not distinct from f.conv_id and f.i = w.i + 1))),
 ends as (
  select w.conv_id, {least("s", "a")} as best from walk w left join counted c on w.conv_id is not distinct from c.conv_id
  where w.i = coalesce(c.n, 0))
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
 coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, best.c::bigint as cost, best.e as audit,
 sha256(best.x) as repaired_sha256
from ends e left join counted c on e.conv_id is not distinct from c.conv_id left join illegal l on e.conv_id is not distinct from l.conv_id"""


def _license_sql() -> str:
    phrases = [(t, True) for t in license_scan.PHRASES] + [(t, False) for t in license_scan.TEMPLATES]
    labels, words, keys = [], [], []
    for number, (t, base) in enumerate(phrases):
        labels.append(f"({number}, '{t.label}', {base})")
        words += [f"({number}, '{w}', {k})" for k, w in enumerate(t.words)]
        for key, (at, phrase) in enumerate(t.phrases()):
            keys += [f"({number}, {key}, {at}, '{w}', {k}, {len(phrase)})" for k, w in enumerate(phrase)]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with template(t, label, base) as (values {", ".join(labels)}),
 template_words(t, word, k) as (values {", ".join(words)}),
 key_words(t, key, pos, word, k, n) as (values {", ".join(keys)}),
 docs as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
 every as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) - 1 as place from docs),
 hits as materialized (select * from every where word in (select word from template_words)),
 idf as materialized (
  select word, ln(((select count(*) from docs) + 1) / (count(distinct doc_id) + 1)) + 1 as idf
  from (select distinct word from template_words) left join hits using (word) group by word),
 begun as materialized (
  select doc_id, t, key, pos, place - k as place from hits join key_words using (word)
  group by doc_id, t, key, pos, place - k, n having count(*) = n),
 begins as (select distinct doc_id, t, key, floor((place - pos) / {license_scan.TOLERANCE}.0)::bigint as bucket from begun),
 agreed as materialized (
  select a.doc_id, a.t, a.bucket from begins a join begins b on a.doc_id = b.doc_id and a.t = b.t and abs(a.bucket - b.bucket) <= 1
  where a.key = 0 group by a.doc_id, a.t, a.bucket
  having count(distinct b.key) = (select count(distinct key) from key_words k where k.t = a.t)),
 stands as (
  select distinct a.doc_id, a.t, w.k, w.word from agreed a join template_words w on a.t = w.t
  join hits h on h.doc_id = a.doc_id and h.word = w.word and abs(floor((h.place - w.k) / {license_scan.TOLERANCE}.0)::bigint - a.bucket) <= 1),
 shares as (
  select doc_id, t, round(sum(idf) / (select sum(idf) from template_words w join idf using (word) where w.t = stands.t), 6) as share
  from stands join idf using (word) group by doc_id, t),
 found as (select doc_id, label, base, share from shares join template using (t) where base or share >= {license_scan.ACCEPT}),
 places as (select doc_id, count(*) as n, min(place) as low, max(place) as high from begun join template using (t) where base group by doc_id),
 named as (
  select doc_id, string_agg(distinct label, ',' order by label) filter (base) as base_labels,
   string_agg(distinct label, ',' order by label) as labels, max(share) as score
  from found group by doc_id)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(p.n, 0)::bigint as n_base, p.low::bigint as first_word,
 p.high::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from docs d left join places p on d.doc_id = p.doc_id left join named n on d.doc_id = n.doc_id"""


def _middle_sql() -> str:
    p, s, m = fill_in_middle.PREFIX, fill_in_middle.SUFFIX, fill_in_middle.MIDDLE
    return f"""
with docs as materialized (
 select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
  sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
 drawn as (
  select *, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b,
   ('0x' || h[17:24])::bigint % 100 as keep, ('0x' || h[25:32])::bigint % 100 as turn from docs),
 cut as (
  select doc_id, text, n, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
   array_to_string(u[greatest(a, b) + 1:n], '') as s,
   case when text = '' or contains(text, '{p}') or contains(text, '{s}') or contains(text, '{m}') or keep >= {fill_in_middle.JOINED}
    then 'plain' when turn < {fill_in_middle.SUFFIX_FIRST} then 'spm' else 'psm' end as form from drawn)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars,
 case when form <> 'plain' then length(m) end::bigint as middle_chars,
 sha256(case form when 'plain' then text when 'psm' then '{p}' || p || '{s}' || s || '{m}' || m
  else '{s}' || s || '{p}' || p || '{m}' || m end) as output_sha256,
 sha256(text) as restored_sha256
from cut"""


ORACLE = {
    "op11_conversation_repair": _repair_sql(),
    "op12_license_scan": _license_sql(),
    "op13_fill_in_middle": _middle_sql(),
    "op5_line_windows": _repeats_sql(
        "string_split(text, chr(10))", "unit", line_windows.WINDOW,
        f"case when len(ns) = {line_windows.WINDOW} then {line_windows.WINDOW} end", "\n", "n_lines",
    ),
    "op6_sentence_spans": _repeats_sql(
        rf"regexp_extract_all(text, '{sentence_spans.SENTENCE}')",
        r"trim(regexp_replace(lower(unit), '[\x20\x09-\x0D]+', ' ', 'g'))",
        sentence_spans.WORDS,
        f"list_filter(range({sentence_spans.SENTENCES}, {sentence_spans.WORDS + 1}), "
        f"lambda k: k <= len(ws) and list_sum(ws[1:k]) >= {sentence_spans.WORDS})[1]",
        "",
        "n_sentences",
    ),
    "op7_quality_rules": _rules_sql(),
    "op8_impact_topk": """
with whole as materialized (
 select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as q from embeddings
 where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 scored as (
  select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
  from whole a join whole b on a.vec_id <> b.vec_id and a.vec_id % 20 = 0 and len(a.q) = len(b.q))
select query_id, rank::int as rank, vec_id, score from (
 select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 20""",
}
