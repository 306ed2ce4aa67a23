"""The training-data operators against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from occflow.llm import (
    bpe,
    components,
    flow_mix,
    impact_topk,
    language_id,
    line_windows,
    quality_model,
    queries,
    rules,
    sentence_spans,
    simhash,
    virtual_slots,
)
from occflow.llm.common import pieces, table, workspace

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `score` double, `rank x` int"
EDGE = [
    (1, None, "en", "a", None, 0.5, 1),
    (2, "", None, None, 0, None, None),
    (3, " \t\n\v\f\r ", "en", "a", 7, None, None),
    (4, "one two three", "en", None, 13, 1.0, 2),
    (4, "one two three", "en", None, 13, 1.0, 2),
    (None, "A null id with a text. And more.\nline two\nline three", "de", "b", 50, None, None),
    (None, "A null id with a text. And more.\nline two\nline three", "de", "b", 50, None, None),
    (5, "12345 !!! ###", None, "", 13, None, None),
    (6, "wort " * 60_000, "de", "b", 300_000, None, None),
    (7, "x" * 200_000, "en", "b", 200_000, None, None),
    (8, "a\nb\nc\na\nb\nc\nd", "en", "c", 13, None, None),
    (9, "a\nb\nc", "en", "c", 5, None, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, EDGE_SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_pieces_cover_the_text():
    for text in ("", "ab", "ab cd ef gh" * 9, "x" * 50):
        assert "".join(pieces(text, 10)) == text


def test_codewords_differ():
    for n in (2, 3, 4, 6, 9, 40):
        code = language_id.codewords(n)
        distance = (code.shape[1] - (code.astype(int) @ code.T.astype(int))) // 2
        np.fill_diagonal(distance, 99)
        assert distance.min() >= (1 if n < 4 else 2)
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_language_held_out_accuracy(spark, sf_dir, docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in queries.op1_language_id(spark, sf_dir).collect() if r["held_out"]]
    assert len(held) > 20
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in held)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)


def test_language_edges(edge, docs):
    model = language_id.train(docs)
    found = by_id(language_id.predict(edge, model))
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 5)] == ["und"] * 4
    assert found[6]["rank x"] is None and found[7]["lang_pred"] != "und"
    none = language_id.train(docs.where("false"))
    assert {r["lang_pred"] for r in language_id.predict(edge, none).collect()} == {"und"}
    one = language_id.train(docs.where("lang = 'de'"))
    assert by_id(language_id.predict(edge, one))[4]["lang_pred"] == "de"
    assert language_id.predict(edge.where("false"), model).count() == 0


def test_quality_held_out(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    rows = [r for r in queries.op2_quality_model(spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    good = [r["score"] for r in rows if labels[r["doc_id"]] == 1]
    bad = [r["score"] for r in rows if labels[r["doc_id"]] == 0]
    pairs = [(g > b) for g in good for b in bad]
    assert not pairs or sum(pairs) / len(pairs) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_edges(spark, edge):
    weights = quality_model.train(edge.where("false").withColumn("quality", F.lit(1)), workspace(spark))
    assert {r["score"] for r in quality_model.predict(edge, weights).collect()} == {0.5}
    owner, bucket, value = quality_model.features([None, "", "A b b B", "x " * 30], 10)
    assert set(owner) == {2, 3}
    assert np.isclose(np.bincount(owner, weights=value**2)[2:], 1).all()


def test_slots(spark, edge, docs):
    for source, count in ((docs, docs.count()), (edge, len(EDGE)), (edge.where("false"), 0)):
        rows = virtual_slots.shard(source, workspace(spark)).collect()
        assert len(rows) == count
        places = defaultdict(list)
        for r in rows:
            places[r["shard"]].append(r["slot"])
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
    found = by_id(virtual_slots.shard(docs, workspace(spark)))
    size = Counter()
    for r in docs.collect():
        data = r["text"].encode()
        assert (found[r["doc_id"]]["size"], found[r["doc_id"]]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        size[found[r["doc_id"]]["shard"]] += len(data) + 1
    assert len(size) == 16 and max(size.values()) - min(size.values()) <= max(len(r["text"]) for r in docs.collect())


def test_repeated_rows_spread_over_shards(spark):
    same = spark.range(9000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text of many").alias("text"))
    rows = same.union(spark.range(9000).select("id", F.concat(F.lit("text "), "id")))
    found = virtual_slots.shard(rows, workspace(spark)).select("doc_id", "shard", "slot", "size").collect()
    size, places = Counter(), defaultdict(list)
    for r in found:
        size[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(found) == 18_000 and sum(r["doc_id"] is None for r in found) == 9000
    assert len(size) == 16 and max(size.values()) - min(size.values()) < sum(size.values()) / 160
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_rebalancing_moves_only_the_excess(spark):
    loads = spark.createDataFrame([(s, 10 if s % 4 else 30) for s in range(64)], "slot long, bytes long")
    before = virtual_slots.first_map(spark, 4, 64)
    after = virtual_slots.rebalance(before, loads, 4)
    old, new = ({r["slot"]: r["shard"] for r in t.collect()} for t in (before, after))
    assert set(old) == set(new)
    assert all(old[s] == 0 for s in old if old[s] != new[s])
    total = Counter()
    for s, shard in new.items():
        total[shard] += 10 if s % 4 else 30
    assert max(total.values()) - min(total.values()) <= 30  # the largest slot


def test_water_fill_and_route():
    target = flow_mix.water_fill({"a": 10, "b": 100, None: 100}, (5, 2, 1), 1.5, 2.0)
    assert target["a"] == 20 and np.isclose(sum(target.values()), 315)
    plan = flow_mix.route({("a",): 10, ("a", "b"): 10, ("b",): 10}, {"a": 20, "b": 15}, 2)
    sent = Counter()
    for cuts in plan.values():
        for stretch in cuts:
            for source, words in stretch:
                sent[source] += words
            assert sum(w for _, w in stretch) <= 10
    assert sent == {"a": 20, "b": 15}
    # 35 words from 30: only 5 are repeated.
    assert sum(w for cuts in plan.values() for _, w in cuts[1]) == 5


def test_mix(spark, sf_dir, docs):
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    rows = queries.op4_flow_mix(spark, sf_dir).collect()
    assert len(rows) == len(source)
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        largest[source[r["doc_id"]]] = max(r["size"], largest[source[r["doc_id"]]])
    # A source has ten documents here; what is left is less than one of them.
    assert all(abs(taken[s] - t) <= largest[s] for s, t in target.items())
    again = {r["doc_id"]: r["taken"] for r in queries.op4_flow_mix(spark, sf_dir).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_edges(spark, edge):
    taken, _ = queries.mix_by_source(edge, workspace(spark))
    rows = taken.collect()
    assert len(rows) == len(EDGE)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert queries.mix_by_source(edge.where("false"), workspace(spark))[0].count() == 0


def brute_cleaned(texts, cut, normal, length, glue):
    """``length`` tells how many of the units ahead make the run that begins there, None if none does."""
    units = {d: cut(t) for d, t in texts.items()}
    seen, gone = set(), defaultdict(set)
    for d in sorted(units):
        plain = [normal(u) for u in units[d]]
        for i in range(len(plain)):
            k = length(plain[i:])
            if k is None:
                continue
            run = tuple(plain[i : i + k])
            if run in seen:
                gone[d].update(range(i, i + k))
            seen.add(run)
    return {d: glue.join(u for i, u in enumerate(units[d]) if i not in gone[d]) if gone[d] else texts[d] for d in texts}


def shortest(words):
    def length(ahead):
        held = 0
        for k, unit in enumerate(ahead, 1):
            held += len(unit.split(" "))
            if k >= 2 and held >= words:
                return k
        return None

    return length


def test_line_windows(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    wanted = brute_cleaned(texts, lambda t: t.split("\n"), lambda u: u, lambda ahead: 3 if len(ahead) > 2 else None, "\n")
    assert {r["doc_id"]: r["text"] for r in line_windows.dedup_lines(docs).collect()} == wanted


def test_sentence_spans(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    cut = re.compile(sentence_spans.SENTENCE).findall
    normal = lambda u: re.sub(r"[\x20\x09-\x0D]+", " ", u.lower()).strip(" ")
    wanted = brute_cleaned(texts, cut, normal, shortest(sentence_spans.WORDS), "")
    assert {r["doc_id"]: r["text"] for r in sentence_spans.dedup_sentences(docs).collect()} == wanted


def test_spans_of_short_sentences(spark):
    talk = "Who? Me. Yes! No. Why? Go on. So be it! Oh. Fine. Well, all right. Hm. Ok. " * 2
    rows = [
        (1, f"One begins here. {talk}One ends."),
        (2, f"Two starts. {talk}Two stops."),
        (3, "Born in the U.S.A. they say."),
        (4, "Made in the U.S.A. he says."),
        (5, "Only one sentence that is very long and " + "goes on and " * 20 + "ends."),
        (6, "Only one sentence that is very long and " + "goes on and " * 20 + "ends."),
    ]
    found = by_id(sentence_spans.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string"), words=10))
    # The second half of the talk repeats the first, so that nothing is left of it in the second text.
    assert found[1]["n_removed"] > 0 and found[2]["text"] == "Two starts. Two stops."
    assert all(found[d]["n_removed"] == 0 for d in (3, 4, 5, 6))
    cut, normal = re.compile(sentence_spans.SENTENCE).findall, lambda u: " ".join(u.lower().split())
    rng = random.Random(6)
    texts = {d: "".join(rng.choice(["a. ", "b c! ", "d\n", "e f g h? ", "x " * 9 + "y. ", "z " * 25 + "\n"]) for _ in range(60)) for d in range(30)}
    for words in (1, 5, 10, 20):
        given = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        found = {r["doc_id"]: r["text"] for r in sentence_spans.dedup_sentences(given, words=words).collect()}
        assert found == brute_cleaned(texts, cut, normal, shortest(words), "")


def test_run_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 64, 50, dtype=np.uint64)
    whole = np.concatenate([hashes[:20], hashes, hashes[5:30]])
    start, units = sentence_spans.shortest_runs(np.ones(len(whole), dtype=int), 4)
    found = sentence_spans.run_hashes(whole, start, units)
    runs = defaultdict(set)
    for s, k, h in zip(start, units, found):
        runs[tuple(whole[s : s + k])].add(h)
    assert all(len(h) == 1 for h in runs.values()) and len(set().union(*runs.values())) == len(runs)


def test_repeat_edges(edge):
    found = line_windows.dedup_lines(edge).collect()
    assert len(found) == len(EDGE)
    text = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in found}
    assert text[1] == (None, 0, 0) and text[2] == ("", 1, 0)
    assert text[8] == ("a\nb\nc\nd", 7, 3) and text[9] == ("", 3, 3)
    assert text[None][2] == 0  # equal rows are one document
    assert line_windows.dedup_lines(edge.where("false")).count() == 0
    spans = sentence_spans.dedup_sentences(edge)
    assert spans.count() == len(EDGE) and spans.where("doc_id = 1").first()["text"] is None


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_rules(edge, docs):
    for source in (docs, edge):
        for r in rules.judge(source).collect():
            n = brute_rules(r["text"])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
            assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
            assert not (r["base_failed"] and r["kept"])
    assert rules.judge(edge.where("false")).count() == 0
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_of_short_texts(spark):
    plain = "the cat and a dog ran over to see us".split()  # ten words
    texts = {
        "few_symbols": " ".join(plain[:-1] + ["&&&%"]),
        "mean_word_length": " ".join(w + "x" * 20 for w in plain),
        "few_repeated_lines": "\n".join(["to us", "to us", "to us", " ".join(plain)]),
        "few_shouted_words": " ".join(w + "!!" for w in plain),
        "": " ".join(plain),
        " ": " ".join(f"nostop{i}" for i in range(19)),  # too short for the rule of stop words
        "stop_words": " ".join(f"nostop{i}" for i in range(20)),
    }
    found = rules.judge(spark.createDataFrame(list(texts.items()), "name string, text string")).collect()
    for r in found:
        assert not r["base_failed"] and r["failed_rules"] == [r["name"].strip()] * bool(r["name"].strip())
        assert r["kept"] == (not r["name"].strip())


def brute_top(vectors, k):
    whole = []
    for i, v in vectors:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [int(x) * 64 if np.isinf(64.0 * x) else int(np.floor(64.0 * x)) for x in map(float, v)]))
    out = Counter()
    for q, a in whole:
        if q % 20 == 0:
            ranked = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q and len(a) == len(b))[:k]
            clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
            out.update((q, rank + 1, c, clip(-s)) for rank, (s, c) in enumerate(ranked))
    return out


def found_top(df):
    return Counter(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_top_k(spark, sf_dir):
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    assert found_top(queries.op8_impact_topk(spark, sf_dir)) == brute_top(vectors, 20)
    # Small blocks, so that several blocks and runs meet and the proof has to hold across them.
    small = impact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, workspace(spark), block_bytes=1 << 14, query_bytes=1 << 13)
    assert found_top(small) == brute_top(vectors, 20)


def test_top_k_of_components_of_any_size(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    rows += [(200 + i, [rng.choice((1e9, -1e9, 1e15, 3.5, 1e9 + 1, 0.0, -1e15)) for _ in range(4)]) for i in range(60)]
    rows += [(300 + i, [rng.choice((1e200, -1e200, 1.7e308, -1.7e308, 1.0, 1e-300)) for _ in range(4)]) for i in range(25)]
    rows += [(400, [1e15, 1.0, 0.0, 0.0]), (420, [1e15, 1.0, 0.0, 0.0]), (421, [1e15, 1.015625, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for size in (1 << 12, 1 << 20):
        found = impact_topk.top_k(frame, F.col("vec_id") % 20 == 0, workspace(spark), k=7, block_bytes=size, query_bytes=size)
        assert found_top(found) == brute_top(rows, 7)


def test_most_queries_end_by_proof(spark):
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in vectors], dtype=np.float64)
    ids = np.array([r["vec_id"] for r in vectors])
    block = impact_topk.Block(impact_topk._pack(ids, x, 64), 64)
    asked = impact_topk.Block(impact_topk._pack(ids[ids % 20 == 0], x[ids % 20 == 0], 64), 64)
    _, told = impact_topk.search_block(asked, block, 20, np.full(asked.n, -np.inf))
    assert told["proved"] > 0.9 * told["queries"]


def test_top_k_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (20, [0.0, 0.0]), (None, [1.0, 1.0])]
    rows += [(40, []), (60, [1.0]), (61, [2.0]), (80, [1.0, 0.0]), (80, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("block", F.lit(2))
    assert found_top(impact_topk.top_k(frame, F.col("vec_id") % 20 == 0, workspace(spark), k=2)) == brute_top(rows, 2)
    assert impact_topk.top_k(frame.where("false"), F.col("vec_id") % 20 == 0, workspace(spark)).count() == 0


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ordered = sorted(points)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in points}


def test_near_duplicates(spark, edge, docs):
    for source in (docs, edge):
        rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in source.collect()]
        group = brute_components({f for _, f in rows})
        least = {}
        for d, f in rows:
            if d is not None:
                least[group[f]] = min(d, least.get(group[f], d))
        wanted = Counter((d, f"{f:016x}", least.get(group[f])) for d, f in rows)
        found = simhash.near_duplicates(source, workspace(spark)).select("doc_id", "fingerprint", "component_id")
        assert Counter(tuple(r) for r in found.collect()) == wanted
    assert simhash.near_duplicates(edge.where("false"), workspace(spark)).count() == 0
    kept = simhash.one_of_each(edge, workspace(spark))
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect())[:2] == [-1, 1]


def test_links_of_dense_cells(spark):
    rng = random.Random(3)
    points = set()
    for _ in range(20):
        base = rng.getrandbits(64)
        for _ in range(60):
            points.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    points |= {rng.getrandbits(64) for _ in range(300)}
    frame = spark.createDataFrame([(simhash._signed(p),) for p in points], "fp long")
    for limit in (simhash.CELL, 5):  # the second cuts crowded cells into chunks
        edges = simhash.links(frame, workspace(spark), cell_limit=limit)
        found = {r["node"]: r["component"] for r in components.components(edges, workspace(spark)).collect()}
        groups = defaultdict(set)
        for p, root in brute_components(points).items():
            groups[root].add(simhash._signed(p))
        wanted = {n: min(g) for g in groups.values() if len(g) > 1 for n in g}
        assert found == wanted


def test_tiles_of_hot_cells_are_bounded(spark, monkeypatch):
    # Cells that many points look into and few are stored in, and one with many stored points.
    points = {0} | {1 << (2 * k) | rest << 32 for k in range(12) for rest in range(200)}
    points |= {sum(1 << (2 * k + (n >> k & 1)) for k in range(10)) | 1 << 60 for n in range(1 << 10)}
    frame = spark.createDataFrame([(simhash._signed(p),) for p in sorted(points)], "fp long")
    stage, limit, sent = workspace(spark), 64, []

    def counted(self, f, schema, *a, whole=type(frame).mapInArrow):
        if f is simhash._scan:
            sent.extend(self.groupBy("cell", "chunk", "probe").count().collect())
        return whole(self, f, schema, *a)

    monkeypatch.setattr(type(frame), "mapInArrow", counted)
    edges = simhash.links(frame, stage, cell_limit=limit)
    monkeypatch.undo()
    assert sum(r["count"] for r in sent) > len(points) and max(r["count"] for r in sent) <= 2 * limit
    found = {r["node"]: r["component"] for r in components.components(edges, workspace(spark)).collect()}
    groups = defaultdict(set)
    for p, root in brute_components(points).items():
        groups[root].add(simhash._signed(p))
    assert found == {n: min(g) for g in groups.values() if len(g) > 1 for n in g}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(edges, workspace(spark)).collect()}
    assert found == {i: 0 for i in range(101)} | {400: 400, 500: 400}
    assert components.components(edges.where("false"), workspace(spark)).count() == 0


def test_bpe_equals_the_library(edge, docs):
    path = public_tokenizers.path(queries.TOKENIZER)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    vocabulary = bpe.load(path)
    encoder = bpe.Encoder(vocabulary)
    rng = random.Random(5)
    texts = [r["text"] or "" for r in [*docs.collect(), *edge.collect()]]
    texts += ["a<|endoftext|>b<|startoftext|>", "ΣΑΣ ΟΔΟΣ don't WE'LL 42", "café  x\x85y\x1cz", "é" * 100]
    texts += ["".join(chr(rng.randrange(0x20, 0x2FF)) for _ in range(rng.randrange(200))) for _ in range(300)]
    # Letters and marks that Python and the tokenizer know differently, alone and among other marks.
    unlike = "".join(map(chr, np.flatnonzero(vocabulary.rare & bpe.UNLIKE)))
    texts += [f"a{c}\u0335B{c}\u0301" for c in unlike] + ["\U00011935\U00011930", "\u1c89x \ua7cb"]
    marks = unlike + "\u0301\u0323\u0335\u05b0aE"
    texts += ["".join(rng.choice(marks) for _ in range(rng.randrange(20))) for _ in range(300)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert encoder.encode(text) == ids
        assert bpe.decode(ids, vocabulary) == decoded
        assert encoder.digests(text) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
    rows = bpe.decode_rows(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert all(r["decoded"] == bpe.decode(r["ids"], vocabulary) for r in rows)
    assert bpe.digests(edge.where("false"), vocabulary).count() == 0


def test_short_and_long_merges_agree():
    vocabulary = bpe.load(public_tokenizers.path(queries.TOKENIZER))
    rng = random.Random(1)
    for _ in range(300):
        data = "".join(rng.choice("thineaor") for _ in range(rng.randrange(1, 120))).encode()
        parts = [vocabulary.inner[b] for b in data[:-1]] + [vocabulary.final[data[-1]]]
        assert bpe._merge_short(list(parts), vocabulary) == bpe._merge_long(list(parts), vocabulary)
