"""SimHash near-dedup against a brute-force version."""

import random

import pytest
import xxhash

from candlewick.llm.simhash import fingerprint, one_of_each, simhash_groups

BLANKS = " \t\n\x0b\x0c\r"


def brute_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for b in BLANKS:
        low = low.replace(b, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    root = {f: f for f in prints.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    found = sorted(root)
    for i, a in enumerate(found):
        for b in found[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                root[find(a)] = find(b)
    least = {}
    for doc, f in prints.items():
        least[find(f)] = min(doc, least.get(find(f), doc))
    return {doc: least[find(f)] for doc, f in prints.items()}


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["Lorem", "ipsum", "dolor", "sit", "amet", "élan", "ÉTÉ", "x y", "z"]
    texts = [" ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(120)) for _ in range(60)]
    for t in texts[:30]:  # near copies, chains of them, exact copies
        parts = t.split(" ")
        for _ in range(4):
            parts[rng.randrange(len(parts))] = "changed"
            texts.append(" ".join(parts))
        texts.append(t)
    texts += [None, "", " \t\n", "one", "One", "two words", "a b c", "a b c d", "A\u000bb\r\nc  d", "\u0085x y z w v"]
    texts.append("word " * 300_000 + "end")
    return dict(enumerate(texts))


def test_fingerprint_is_the_definition():
    for text in corpus().values():
        if text is None or len(text) < 100_000:
            assert fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    import candlewick.llm.simhash as S

    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = S.fingerprint(text.encode())
    blocks = S.word_blocks
    monkeypatch.setattr(S, "word_blocks", lambda data: blocks(data, 7))
    assert S.fingerprint(text.encode()) == whole == brute_fingerprint(text)
    assert S.fingerprint(b"ab c") == brute_fingerprint("ab c")


@pytest.mark.parametrize("radius,tile_rows", [(4, 4096), (4, 2), (8, 5)])
def test_groups_match_brute_force(spark, radius, tile_rows):
    docs = corpus()
    rows = [(i, t, "x", 7) for i, t in docs.items()]
    # columns with the names of the result and of internals must not disturb
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int")
    got = {r["doc_id"]: r for r in simhash_groups(df, radius=radius, tile_rows=tile_rows).collect()}
    prints = {i: (fingerprint(t.encode()) if t else 0) for i, t in docs.items()}
    want = brute_groups(prints, radius)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in prints.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_empty_nulls_and_repeats(spark):
    schema = "doc_id long, text string, source string"
    empty = spark.createDataFrame([], schema)
    assert simhash_groups(empty).collect() == []
    assert one_of_each(empty).collect() == []
    rows = [(5, "a b c d e", "s"), (5, "a b c d e", "s"), (2, "a b c d e", None), (None, "a b c d e", "s"),
            (None, "q w e r t", "s"), (9, None, None), (8, "", "s")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in simhash_groups(df).collect()), key=repr)
    assert [g for g in got if g[0] == 5] == [(5, 2, False)] * 2
    assert (2, 2, True) in got and (9, 8, False) in got and (8, 8, True) in got
    assert (-1, None, True) in got and (-1, 2, False) in got
    kept = [r["doc_id"] for r in one_of_each(df).collect()]
    assert kept.count(2) == 1 and kept.count(8) == 1 and 5 not in kept and 9 not in kept
    twice = spark.createDataFrame([(1, "x y z", "s"), (1, "x y z", "s")], schema)
    assert len(one_of_each(twice).collect()) == 1


def test_components_of_a_long_path(spark):
    from candlewick.llm.components import components

    n = 200
    edges = spark.createDataFrame([((i * 37) % n, ((i + 1) * 37) % n) for i in range(n - 1)] + [(500, 500), (None, 3)],
                                  "a long, b long")
    got = {r["node"]: r["component_id"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 500: 500}
