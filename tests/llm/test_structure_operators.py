"""Conversation repair, license scan and fill-in-middle against brute force, and their edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from occflow.llm import conversation_repair as repair
from occflow.llm import fill_in_middle, license_scan, queries
from occflow.llm.common import table

CLASHING = ("kind", "fault", "a", "b", "at", "place", "copy", "hits", "parts", "present", "n", "form", "output", "id", "kept", "c0", "row", "rows", "__rows")


def clashing(df):
    """``df`` with further columns of names that operators use themselves."""
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING) if c not in df.columns])


# Conversation repair


def scripts(rows):
    """Every sequence of edits of ``rows`` (initial, fault) that leaves a legal conversation: (cost, initials)."""

    def walk(k, state, cost, letters, inserted):
        if k == len(rows) and state in "-a":
            yield cost, letters
        need = {"-": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 2:
            yield from walk(k, need, cost + 2, letters + "I", inserted + 1)
        if k < len(rows):
            initial, fault = rows[k]
            cut = fault == repair.TRUNCATED
            yield from walk(k + 1, state, cost + 3, letters + "D", 0)
            if fault not in (repair.BLANK, repair.DUPLICATE):
                if initial == need or (initial == "s" and state == "-"):
                    yield from walk(k + 1, initial, cost + cut, letters + "K", 0)
                yield from walk(k + 1, need, cost + 2 + cut, letters + "R", 0)

    return walk(0, "-", 0, "", 0)


def searched(rows):
    search, letters, most = repair.Search(), "", 0
    for k, (initial, fault) in enumerate(rows):
        letters += "".join(e[0] for e in search.push(initial, fault, (initial, str(k))))
        most = max(most, search.held)
    cost, rest = search.close()
    return cost, letters + "".join(e[0] for e in rest), most


def by_strings(rows):
    """The same search with whole strings in each state."""
    far = (10**9, "")
    add = lambda way, cost, letter: (way[0] + cost, way[1] + letter)
    best = {"-": (0, ""), "s": far, "u": far, "a": far}

    def insert(now):
        now["u"] = min(now["u"], *[add(now[z], 2, "I") for z in "-sa"])
        now["a"] = min(now["a"], add(now["u"], 2, "I"))
        return now

    best = insert(best)
    for initial, fault in rows:
        now = {z: add(best[z], 3, "D") for z in best}
        cut = fault == repair.TRUNCATED
        if fault not in (repair.BLANK, repair.DUPLICATE):
            for z in "-sua":
                to = "a" if z == "u" else "u"
                now[to] = min(now[to], add(best[z], 2 + cut, "R"))
                if initial == to:
                    now[to] = min(now[to], add(best[z], cut, "K"))
            if initial == "s":
                now["s"] = min(now["s"], add(best["-"], cut, "K"))
        best = insert(now)
    return min(best["-"], best["a"])


def test_search_finds_the_cheapest_least_edits():
    choices = list(itertools.product("suax", range(4)))
    rng = random.Random(5)
    cases = [[c] for c in choices] + [rng.choices(choices, k=rng.randrange(5)) for _ in range(150)]
    for rows in cases:
        assert searched(rows)[:2] == min(scripts(rows)), rows


def test_search_agrees_with_whole_strings_on_long_conversations():
    rng = random.Random(6)
    for pool in ("ua", "suax", "u", "x", "s", "su", "aax"):
        for n in (0, 7, 60, 200):
            rows = [(rng.choice(pool), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(n)]
            assert searched(rows)[:2] == by_strings(rows), (pool, rows)
            assert searched([(r[0], 0) for r in rows])[:2] == by_strings([(r[0], 0) for r in rows])


def test_search_holds_the_unresolved_part_only():
    rng = random.Random(7)
    rows = [("ua"[k % 2] if rng.random() < 0.9 else rng.choice("suax"), rng.choice((0,) * 9 + (1, 2, 3))) for k in range(30_000)]
    assert searched(rows)[2] < 200
    assert searched([("u", repair.BLANK)] * 5000)[2] < 200
    # Nothing is decided before the end here, and no row is lost.
    assert len(searched([("x", 0)] * 3000)[1]) >= 3000


def expected_repair(turns):
    """Per conversation what the contract asks for, from (conv_id, turn, role, text)."""
    some = lambda x: " " if x is None else str(x)
    word = re.compile(r"[^\x20\x09-\x0D]")
    out, conversations = {}, {}
    for conv, turn, role, text in turns:
        rows = conversations.setdefault(conv, [])
        kind = zlib.crc32(f"{some(conv)}:{some(turn)}".encode()) % 20
        role, text = some(role), some(text)
        if kind:
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in rows:
            marks = word.findall(text)
            faults.append(1 if not marks else 2 if (role, text) in seen else 0 if marks[-1] in ".!?" else 3)
            seen.add((role, text))
        known = {r[0] for r in rows if r[0] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, letters = by_strings(list(zip(initials, faults)))
        left, state, at = [], "-", 0
        for e in letters:
            need = "assistant" if state == "u" else "user"
            if e != "I":
                _, role, text = rows[at]
                at += 1
            if e == "D":
                continue
            role, text = (role, text) if e == "K" else (need, "" if e == "I" else text)
            state = role[:1]
            left.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, letters, digest)
    return out


def found_repair(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_repair_of_the_table(spark, sf_dir):
    turns = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found_repair(queries.op11_conversation_repair(spark, sf_dir)) == expected_repair(turns)


EDGE_TURNS = [
    (1, 0, "user", "Hello."),
    (1, 1, "assistant", "Yes."),
    (1, 5, "user", "Hello."),
    (1, 5, "user", "Hello."),
    (2, None, None, None),
    (2, None, "system", "Be kind."),
    (2, 3, "tool", "x" * 100_000),
    (None, 1, "user", "No id!"),
    (None, None, "assistant", " \t\n"),
    (3, 1, "", "No role."),
    (3, 1, "assistant", "A. "),
    (3, 1, "user", "A. "),
    (4, -5, "assistant", "Far"),
    (4, 9, "assistant", "apart"),
    (4, 9, "assistant", "apart"),
    (4, 12, "assistant", "apart"),
] + [(7, k, "user" if k % 3 else "assistant", f"turn {k % 11}.") for k in range(400)]


def edge_turns(spark, turns):
    return spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")


def test_repair_of_edge_cases(spark, stage):
    turns, dropped = queries.damaged(edge_turns(spark, EDGE_TURNS))
    turns = turns.withColumnRenamed("kind", "was").transform(clashing)
    found = repair.audit(turns, stage, absent=F.col("was") == 0)
    assert found_repair(found) == expected_repair(EDGE_TURNS)
    assert dropped is not None


def test_repaired_turns_make_the_digest(spark, stage):
    whole = edge_turns(spark, EDGE_TURNS).transform(clashing)
    edits, digests = {}, {}
    for r in repair.repair(whole, stage).collect():
        rows = edits.setdefault(r["conv_id"], [])
        assert r["place"] == len(rows)
        rows.append(r)
    for r in repair.audit(whole, stage).collect():
        digests[r["conv_id"]] = r
    assert edits.keys() == digests.keys()
    for conv, rows in edits.items():
        assert "".join(r["edit"] for r in rows) == digests[conv]["audit"]
        left = [f"{r['role']}:{r['text']}" for r in rows if r["role"] is not None]
        assert hashlib.sha256("\n".join(left).encode()).hexdigest() == digests[conv]["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in rows if r["role"]))


def test_repair_of_no_rows_and_of_dropped_ones(spark, stage):
    none = edge_turns(spark, [])
    assert repair.audit(none, stage).collect() == [] and repair.repair(none, stage).collect() == []
    gone = found_repair(repair.audit(edge_turns(spark, [(5, 1, "user", "x")]), stage, absent=F.lit(True)))
    assert gone == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_a_hot_repeated_turn_is_split(spark, stage, skew_joins):
    turns = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("conv_id"),
        F.col("id").alias("turn"),
        F.lit("user").alias("role"),
        F.when(F.col("id") % 3 == 0, "The same.").otherwise(F.concat(F.lit("x"), "id")).alias("text"),
    )
    turns = stage.table(turns.repartition(8), "turns")
    split, rows = skew_joins(repair.stream(turns, stage))
    assert split
    assert sum(r["kind"] == repair.REPEAT for r in rows) == 19_999


# License scan


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def phrase_places(words):
    found = []
    for t in license_scan.PHRASES:
        n = len(t.words)
        found += [(k, t.label) for k in range(len(words) - n + 1) if words[k : k + n] == t.words]
    return sorted(found)


LICENSED = [
    (1, "Released under the MIT License."),
    (2, "x Apache License, Version 2.0. Under the MIT license; under the mit license CC-BY-NC"),
    (3, None),
    (4, ""),
    (5, " .. "),
    (6, "under the mit licence, apache license version 3, cc by"),
    (7, "UNDER THE\nMIT\tLICENSE"),
    (8, "under the mit lıcense, apache lİcense version 2, cc by nç, Keep"),
    (9, "wort " * 50_000 + "under the mit license"),
    (10, "apache license version " * 3000 + "2"),
    (10, "apache license version " * 3000 + "2"),
    (None, "This work is licensed under the GNU General Public License, version 3."),
    (
        11,
        "Redistribution and use in source and binary forms, with or without modification, are permitted by us (ACME) "
        "provided that the following conditions are met: ask first.",
    ),
    (12, "Redistribution and use in source and binary forms. " + "word " * 100 + "provided that the following conditions are met"),
    (13, "the gnu general public license, either version 2 of the License"),
    (14, "-under the mit license-" * 40),
]


@pytest.fixture(scope="module")
def licensed(spark):
    return spark.createDataFrame(LICENSED, "doc_id long, text string")


def test_phrases_are_found_where_they_stand(licensed, stage):
    found = license_scan.scan(clashing(licensed), stage).collect()
    assert len(found) == len(LICENSED)
    got = sorted((str(r["doc_id"]), r["n_words"], list(r["places"]), list(r["phrase_labels"])) for r in found)
    want = []
    for doc, text in LICENSED:
        places = phrase_places(words_of(text))
        want.append((str(doc), len(words_of(text)), [p for p, _ in places], sorted({label for _, label in places})))
    assert got == sorted(want)


def test_templates_need_all_key_phrases_near_their_places(licensed, stage):
    found = {r["doc_id"]: r for r in license_scan.scan(licensed, stage).collect()}
    assert found[None]["labels"] == ["gpl-3"] and found[None]["phrase_labels"] == []
    assert found[11]["labels"] == ["bsd"] and 0.6 <= found[11]["score"] < 1
    assert found[12]["labels"] == [] and found[12]["score"] == 0
    assert found[13]["labels"] == []
    assert found[2]["labels"] == ["apache-2", "cc-by-nc", "mit"] and found[2]["score"] == 1
    assert all(set(r["phrase_labels"]) <= set(r["labels"]) for r in found.values())
    assert all(list(r["labels"]) == sorted(set(r["labels"])) and 0 <= r["score"] <= 1 for r in found.values())


def test_every_template_finds_itself(spark, stage):
    every = (*license_scan.PHRASES, *license_scan.TEMPLATES)
    docs = spark.createDataFrame([(k, f"Some words. {t.text.upper()}, and more.") for k, t in enumerate(every)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs, stage).collect()}
    for k, t in enumerate(every):
        assert t.label in found[k]["labels"], t
        assert found[k]["score"] == 1


def test_license_scan_runs_in_the_engine(licensed, stage):
    plan = license_scan.scan(licensed, stage)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert "Exchange" not in plan
    empty = licensed.where("false")
    assert license_scan.scan(empty, stage).collect() == []


# Fill-in-middle

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def expected_middle(doc, text):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    (1, None),
    (2, ""),
    (3, "a"),
    (4, "..."),
    (5, "holds <P> a marker"),
    (6, "holds <M>"),
    (7, "ends in <" * 40),
    (8, "<S <P <M> >"),
    (9, "letters" * 40_000),
    (10, "Ünïcödé 𝔘𝔫𝔦 한국어 ́ mixed words, " * 900),
    (11, "\n\r\t\x00 controls"),
    (None, "no id, some words"),
    (12, "x" * 511 + "é" + "y" * 513 + " " + "z" * 512),
    (13, "same row"),
    (13, "same row"),
    *[(100 + k, "word, " * k + "é" * (k % 7) + "end") for k in range(200)],
]


def test_tree_cuts_like_a_linear_scan():
    rng = random.Random(3)
    texts = ["", "a", "é", "ab cd", "x" * 100, "é" * 50] + [
        "".join(rng.choices(["a", "bc", " ", "é", "漢", "𝔘", ".", "longword"], k=rng.randrange(80))) for _ in range(40)
    ]
    for text in texts:
        units = UNITS.findall(text)
        for block in (1, 3, 8, 512):
            tree = fill_in_middle.UnitTree(text.encode(), block)
            assert (tree.units, tree.points) == (len(units), len(text))
            for k in range(len(units) + 1):
                prefix = "".join(units[:k])
                assert tree.cut(k) == (len(prefix.encode()), len(prefix)), (text, block, k)


def test_marks_in_stretches(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "STRETCH", 16)
    text = "words é and 漢字 " * 30
    units = UNITS.findall(text)
    tree = fill_in_middle.UnitTree(text.encode(), 8)
    for k in range(len(units) + 1):
        assert tree.cut(k) == (len("".join(units[:k]).encode()), len("".join(units[:k])))


def test_middle_of_texts(spark):
    docs = clashing(spark.createDataFrame(TEXTS, "doc_id long, text string"))
    made = fill_in_middle.transform(docs)
    assert [c for c in made.columns if c not in fill_in_middle.MADE] == [c for c in docs.columns if c not in fill_in_middle.MADE]
    rows = made.withColumn("restored", fill_in_middle.restore("output", "form")).collect()
    got = sorted((repr((r["doc_id"], r["text"])), (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])) for r in rows)
    assert got == sorted((repr((d, t)), expected_middle(d, t)) for d, t in TEXTS)
    assert all(r["restored"] == (r["text"] or "") for r in rows)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(docs.where("false")).collect() == []


def test_middle_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = queries.op13_fill_in_middle(spark, sf_dir).collect()
    assert len(found) == docs.count()
    for r in found:
        n, form, before, middle, output = expected_middle(r["doc_id"], texts[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"]) == (n, form, before, middle, sha(output))
        assert r["restored_sha256"] == sha(texts[r["doc_id"]] or "")
