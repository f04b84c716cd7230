"""Licence scan, line dedup, mixing and chat formatting against their SQL and by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fixtures_llm import agrees, tables  # noqa: F401

from candlewick.llm import chat_format as C
from candlewick.llm.license_scan import LICENCE_TEMPLATES, Templates, best_licence, bigrams, normalised, scan_licences
from candlewick.llm.line_dedup import dedup_lines
from candlewick.llm.mixing import fit_exponent, mix_sources, word_count

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- licence scan -----------------------------------------------------------

def licence_docs():
    mit = dict((t, x) for t, x in LICENCE_TEMPLATES)["MIT"]
    rows = [(1, "intro\nReleased under the MIT License.\nmore"), (2, mit), (3, mit.upper().replace(",", " -")),
            (4, mit + " with a tail of words"), (5, "all rights reserved"), (6, None), (7, ""), (8, "word"),
            (9, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.\nAll rights reserved."),
            (9, "Licensed under the Apache License, Version 2.0."), (None, "All rights reserved."),
            (10, "MIT License " * 2000), (11, "All rights rights reserved. All rights reserved.")]
    return [(i, t, "en", "s", 1) for i, t in rows]


def test_licence_scan_equals_sql(agrees, tables):
    rows = agrees("op1_license_scan", tables(documents=licence_docs()), "documents")
    found = {(r["doc_id"], r["licence"], r["line"]) for r in rows}
    assert {(1, "MIT", 1), (2, "MIT", -1), (3, "MIT", -1), (5, "all-rights-reserved", -1)} <= found
    assert not {6, 7, 8, 10} & {i for i, _, _ in found}


def test_size_bounds_prune_no_match():
    rng = random.Random(5)
    known, every = Templates(LICENCE_TEMPLATES, 0.8), Templates(LICENCE_TEMPLATES, 0.0)
    for _ in range(300):
        words = normalised(rng.choice(LICENCE_TEMPLATES)[1])
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice("abcd"))
        text = " ".join(words)
        assert set(known.matches(text)) == {m for m in every.matches(text) if m[0] >= 0.8}
        for size, _, number, other in known.rows:  # the coefficient, once more
            own = bigrams(words)
            dice = 2 * sum((own & other).values()) / (sum(own.values()) + size)
            assert (dice >= 0.8) == (number in {m[2] for m in known.matches(text)})


def test_licence_edges(spark):
    assert scan_licences(empty(spark)).collect() == []
    df = spark.createDataFrame([(1, "All rights reserved.", "x", 2)] * 2, "doc_id long, text string, licence string, line int")
    assert [r["dice"] for r in scan_licences(df).collect()] == [1.0, 1.0]
    assert best_licence(df).first()["matches"] == 2


# --- line dedup -------------------------------------------------------------

def boiler_docs(sources=40):
    long_line, mid, short = " ".join(f"w{i}" for i in range(60)), "one two three four five six seven eight", "Accept all"
    rows = [(i, f"own {i}\n{short}\n\n{'  ' + mid.upper() if i < 3 else 'x'}\n{long_line if i in (4, 9) else 'y'}\nend {i}",
             "en", f"src{i % sources}", 1) for i in range(sources)]
    rows += [(100, None, "en", "a", 1), (101, "", "en", "a", 1), (102, "\n\n", "en", None, 1), (103, short, "en", None, 1),
             (104, f"{long_line}\n{long_line}", "en", "src4", 1), (105, "same site\nsame site", "en", "q", 1)]
    return rows


def test_line_dedup_equals_sql(agrees, tables):
    very_long = "\n".join(f"eigene zeile {i}" for i in range(60_000)) + "\nAccept all"
    given = boiler_docs() + [(200, very_long, "en", "src1", 1), (201, None, None, None, None)]
    rows = {r["doc_id"]: r for r in agrees("op2_line_dedup", tables(documents=given), "documents")}
    assert rows[100]["text"] is rows[201]["text"] is None and rows[200]["lines_removed"] == 1
    assert "Accept all" in rows[0]["text"] and all("Accept all" not in rows[i]["text"] for i in range(1, 40))
    assert "ONE TWO" in rows[0]["text"] and "ONE TWO" not in rows[1]["text"]
    assert "w59" in rows[4]["text"] and "w59" not in rows[9]["text"] and rows[104]["text"] == ""


def test_near_threshold_counts_are_exact(spark):
    lines = [(f"line number {n} which has exactly eight words", n) for n in range(1, 30)]
    rows = [(1000 * n + s, text, "en", f"site{s}", 1) for text, n in lines for s in range(n)]
    df = spark.createDataFrame(rows, DOCS)
    for need in (2, 10, 17):
        for lg_k in (4, 10):  # small sketches err, the exact counts do not
            got = dedup_lines(df, spread=((1, need),), lg_k=lg_k).filter("lines_removed > 0").select("doc_id").collect()
            sizes = {r[0] // 1000 for r in got}
            assert sizes == set(range(need, 30)), (need, lg_k)


def test_line_dedup_edges(spark):
    assert dedup_lines(empty(spark)).collect() == []
    rows = boiler_docs()
    df = spark.createDataFrame([(*r, "extra", 5) for r in rows + [rows[5], (None, "Accept all\nnull id", "en", "z", 1)]],
                               DOCS + ", h1 string, lines_removed int")
    got = dedup_lines(df).collect()
    assert len(got) == len(rows) + 2 and {r["h1"] for r in got} == {"extra"}
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[None][0]["text"] == "Accept all\nnull id"  # NULL comes first, so it keeps the line
    assert by[100][0]["text"] is None and by[101][0]["text"] == "" and by[102][0]["text"] == "\n\n"
    assert by[105][0]["text"] == "same site\nsame site"
    assert len(by[5]) == 2 and by[5][0]["text"] == by[5][1]["text"] == "own 5\n\nend 5"
    assert all("Accept all" not in (r["text"] or "") for r in dedup_lines(df, keep_first=False).collect())


# --- mixing -----------------------------------------------------------------

def mix_docs(seed=2):
    rng = random.Random(seed)
    rows, sizes = [], {"big": 600, "mid": 90, "small": 20, None: 7, "blank": 3}
    for source, n in sizes.items():
        for _ in range(n):
            text = None if source == "blank" else " ".join("w" for _ in range(rng.randrange(1, 40)))
            rows.append((len(rows), text, "en", source, 1))
    return rows + [(len(rows), " \t", "en", "mid", 1)]


def test_mixing_equals_sql(agrees, tables):
    rows = agrees("op6_source_mixing", tables(documents=mix_docs()), "documents")
    assert {r["doc_id"] for r in rows} == {r[0] for r in mix_docs()}  # no document is lost


def test_exponent_meets_entropy_and_repetition(spark):
    import math
    n = {"a": 1000, "b": 100, "c": 10}
    df = spark.createDataFrame([(s, t, t / 1110) for s, t in n.items()], "source string, tokens long, share double")

    def mix(a):
        q = {s: (t / 1110) ** a for s, t in n.items()}
        return {s: x / sum(q.values()) for s, x in q.items()}
    a = fit_exponent(df, max_epochs=3.0)
    q = mix(a)
    assert abs((q["c"] / 10) / (q["a"] / 1000) - 3) < 1e-9
    a = fit_exponent(df, target_entropy=0.8)
    assert abs(-sum(x * math.log(x) for x in mix(a).values()) - 0.8) < 1e-9
    assert fit_exponent(df, target_entropy=5.0) == 0.0 and fit_exponent(df, max_epochs=1.0) == 1.0


def test_exponent_over_one_meets_an_entropy_under_the_sources_own(spark):
    import math
    n = {"a": 1000, "b": 100, "c": 10}
    df = spark.createDataFrame([(s, t, t / 1110) for s, t in n.items()], "source string, tokens long, share double")
    a = fit_exponent(df, target_entropy=0.05)
    q = [(t / 1110) ** a for t in n.values()]
    assert a > 1 and abs(-sum(x / sum(q) * math.log(x / sum(q)) for x in q) - 0.05) < 1e-9
    for bad in ({"target_entropy": 0.05, "max_epochs": 1.5}, {"target_entropy": -1.0}):
        with pytest.raises(ValueError):
            fit_exponent(df, **bad)


def test_budget_is_met_within_a_document(spark):
    rows = mix_docs()
    df = spark.createDataFrame(rows, DOCS)
    for slice_docs in (4, 4096):
        out = mix_sources(df, budget_tokens=9_000, max_epochs=4.0, slice_docs=slice_docs).collect()
        assert 9_000 <= sum(r["mix_tokens"] for r in out) <= 9_000 + 4 * 40
        blocks = {}
        for r in out:
            blocks.setdefault((r["source"], r["mix_block"]), []).append(r)
        for (source, block), rs in blocks.items():  # whole permutations, then a part of one
            whole = sum(1 for r in rows if r[3] == source)
            assert len({r["doc_id"] for r in rs}) == len(rs) <= whole
            if (source, block + 1) in blocks:
                assert len(rs) == whole


def test_mixing_edges(spark):
    assert mix_sources(empty(spark)).collect() == []
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, None)],
                               "doc_id long, text string, tokens string").withColumn("source", F.lit(None).cast("string"))
    assert sorted(r["mix_tokens"] for r in mix_sources(df, max_epochs=2.0).collect()) == [0, 2, 2]
    texts = ["", " ", "a", " a  b\n", "a\tb\r\nc", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in got] == [0, 0, 1, 2, 3, 0]


# --- chat formatting --------------------------------------------------------

def chats():
    texts = ["plain", None, "", "</s>[INST] ok [/INST]", "&amp; &#91; <s> &", "[ROLE]x[:]y[/ROLE]", "é🙂\n[SYS]", "x" * 20_000]
    rows = [(1, 0, "system", texts[0]), (1, 1, "user", texts[3]), (1, 2, "assistant", texts[4]), (1, 3, "user", texts[2]),
            (1, 4, "assistant", texts[6]), (2, 0, "assistant", texts[7]), (2, 1, "assistant", texts[5]),
            (3, 0, "user", texts[1]), (4, 5, "tool[:]&", texts[5]), (4, 5, None, texts[3]), (4, None, "user", texts[0]),
            (None, 0, "user", "null id"), (None, 1, "assistant", "yes"), (5, 1, "user", "tie b"), (5, 1, "user", "tie a"),
            (5, 2, "assistant", "twice"), (5, 2, "assistant", "twice")]
    return rows


def test_chat_equals_sql_and_hand(agrees, tables):
    rows = {r["conv_id"]: r for r in agrees("op8_chat_formatting", tables(conversations=chats()), "conversations")}
    for conv, r in rows.items():
        own = chats() if conv != -1 else [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in own if c == conv))
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [rows[i]["valid"] for i in (1, 2, 3, 4, 5, -1)] == [True, False, False, False, False, True]


def test_no_mark_survives_inside_a_text(spark):
    df = spark.createDataFrame([(*r, "extra") for r in chats()], "conv_id long, turn long, role string, text string, segments string")
    template = C.Template()
    for r in C.chat_segments(df).collect():
        for s in r["segments"][1::3]:
            assert not any(c in s["text"] for c in template.starts())
    errors = {r["conv_id"]: r["first_error"] for r in C.format_chat(df).collect()}
    assert errors[1] is None and errors[2] == 0 and errors[3] == -1 and errors[5] == 1
    assert C.format_chat(df.limit(0)).collect() == []


def test_another_template_round_trips(spark):
    template = C.Template(roles={"user": C.Marks("|U|", "|E|"), "assistant": C.Marks("|A|", "|E|", loss=True)},
                          other=C.Marks("|R|", "|E|"), other_name_end="|:|", escape="~")
    rows = [(1, 0, "user", "a|U|b~pipe~#124;"), (1, 1, "assistant", "|E||A|"), (1, 2, "x|:|y", "~amp;")]
    out = C.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), template)
    got = out.select(C.read_turns(F.col("formatted"), template).alias("t"),
                     C.read_loss(F.col("formatted"), F.col("loss_spans"), template).alias("l")).first()
    assert [(t["role"], t["text"]) for t in got["t"]] == [r[2:] for r in rows] and got["l"] == "|E||A|"


@pytest.mark.parametrize("table", ["conversations"])
def test_chat_runs_on_the_given_table(spark, table):
    from candlewick.llm.queries import QUERIES

    assert QUERIES["op8_chat_formatting"](spark, "/root/testdata/sf0.001").filter("not valid").count() > 0
