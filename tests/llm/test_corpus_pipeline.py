"""The corpus pipeline against a plain version of its stages."""

import hashlib
import math
from collections import Counter, defaultdict

import corpus_pipeline
from candlewick.llm.simhash import fingerprint
from candlewick.llm.toxicity import score_toxicity
from fixtures_llm import tables  # noqa: F401
from test_packing import plain as plain_ids
from test_simhash import brute_groups
from test_text_operators import boiler_docs
from test_toxicity import crafted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    docs, labels = crafted(90)
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t, *_ in docs]
    rows += [(1000 + i, t, lang, source, None if t is None else len(t)) for i, t, lang, source, _ in boiler_docs(12)]
    rows += [(2000 + i, rows[1][1] + " x" * (i % 2), "en", "big", 9) for i in range(40)]  # copies and near copies
    rows += [(3000, None, None, None, None), (3001, "", "en", None, 0), (3002, "only words " * 400, "en", "src0", 1)]
    return rows, labels


def lines_brute(rows):
    seen = defaultdict(list)
    for i, t, _, source, _ in rows:
        for pos, raw in enumerate((t or "").split("\n") if t is not None else []):
            line = " ".join(raw.lower().split())
            if line:
                seen[line].append((i, pos, source))
    gone = set()
    for line, places in seen.items():
        words = len(line.split(" "))
        need = 2 if words >= 30 else 3 if words >= 8 else 10
        if len({s for *_, s in places}) >= need:
            first = min((i, p) for i, p, _ in places)
            gone |= {(i, p) for i, p, _ in places} - {first}
    out = []
    for i, t, lang, source, n in rows:
        kept = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone)
        out.append((i, kept, lang, source, n if kept == t else len(kept)))
    return out


def simhash_brute(rows):
    prints = {r[0]: fingerprint(r[1].encode()) if r[1] else 0 for r in rows}
    groups = brute_groups(prints, 4)
    return [r for r in rows if groups[r[0]] == r[0]]


def mixing_brute(rows, limit=2.0):
    tokens = {r[0]: len((r[1] or "").split()) for r in rows}
    total = Counter()
    for r in rows:
        total[r[3]] += tokens[r[0]]
    some = {s: n for s, n in total.items() if n}
    big, small = max(some.values()), min(some.values())
    a = max(0.0, 1 - math.log(limit) / math.log(big / small)) if big > small else 0.0
    out = []
    for s in total:
        epochs = (big / total[s]) ** (1 - a) if total[s] else 1.0
        whole = math.floor(epochs + 1e-9)
        rest = max(0, math.floor((epochs - whole) * total[s] + 0.5))
        own = [r for r in rows if r[3] == s]
        out += own * whole
        done = 0
        for r in sorted(own, key=lambda r: hashlib.md5(f"1|{whole}|{r[0]}".encode()).hexdigest()):
            if done >= rest:
                break
            out.append(r)
            done += tokens[r[0]]
    return out


def as_rows(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_equal_a_plain_version(spark, tables):
    rows, labels = corpus()
    folder = tables(documents=rows, labels=labels)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = score_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    bad = {r["doc_id"] for r in scored if r["predicted"]}
    assert len(bad) > 50
    want = [r for r in rows if r[0] not in bad]
    for name, brute in (("toxicity", lambda x: x), ("line_dedup", lines_brute), ("simhash_near_dedup", simhash_brute),
                        ("source_mixing", mixing_brute)):
        want = brute(want)
        stages[name](spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert as_rows(docs) == sorted(want, key=repr), name
    pieces = stages["packing"](spark, docs, folder).collect()
    tokens = Counter()
    for p in pieces:
        tokens[p["doc_id"]] += p["length"]
    held = Counter()
    for r in want:
        held[r[0]] += len(plain_ids(r[1]))
    assert tokens == held
    whole = corpus_pipeline.run(spark, folder)
    key = lambda p: (p["doc_id"], p["start"], p["length"])
    assert whole.columns == list(pieces[0].asDict()) and sum(p["length"] for p in whole.collect()) == sum(held.values())
    assert {key(p)[0] for p in pieces} == set(held)


def test_stages_take_empty_tables_and_extra_columns(spark, tables):
    rows, labels = corpus()
    folder = tables(documents=rows[1:2], labels=labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == []
        more = docs.selectExpr("*", "1 AS fp", "2 AS score", "'x' AS lines_removed", "3 AS mix_block", "4 AS ids")
        assert stage(spark, more, folder).count() == 1
