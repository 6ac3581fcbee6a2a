import hashlib
import random
import time

import numpy as np
import pytest

from tidemark.llm import common
from tidemark.llm.components import components, forest
from tidemark.llm.exact_dedup import _ENTRY, _KEY, exact_dedup, merge_runs, sorted_run
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.near_dedup import BLOCK, _pack, _unpack, links, near_dedup, shingle_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


@pytest.mark.parametrize("keep, best", [("smallest", min), ("largest", max)])
def test_exact_dedup_equals_brute_force(spark, keep, best):
    rng = random.Random(1)
    rows = [(i, rng.choice(["A b", "a B", "é", "É", None, "", f"t{rng.randrange(40)}", "hot" if i % 3 else "HOT"])) for i in range(600)]
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = {(i, best(g), len(g), i == best(g), hashlib.sha256(t.encode()).digest()) for t, g in groups.items() for i in g}
    found = exact_dedup(spark.createDataFrame(rows, DOCS).repartition(13), keep)
    assert {(*r[:4], bytes(r[4])) for r in found.collect()} == want


def test_exact_dedup_of_odd_rows(odd_docs, no_docs):
    found = {}
    for r in exact_dedup(odd_docs).collect():
        found.setdefault(r["doc_id"], set()).add((r["keep_id"], r["group_size"], r["kept"]))
    assert found[1] == found[1] and (1, 3, True) in found[1] and found[2] == {(1, 3, False)}
    assert found[4] == {(4, 4, True)} and found[5] == {(4, 4, False)} and found[None] == {(4, 4, False), (1, 3, False)}
    assert exact_dedup(no_docs).count() == 0
    with pytest.raises(ValueError):
        exact_dedup(no_docs, "first")


@pytest.mark.parametrize("keep, best", [("smallest", min), ("largest", max)])
def test_merged_runs_equal_brute_force(keep, best):
    rng = np.random.default_rng(2)
    for values in (1, 3, 3, 50) * 10:
        parts = []
        for size in rng.integers(0, 40, rng.integers(0, 20)):
            part = np.zeros(size, _ENTRY)
            for k in _KEY:
                part[k] = rng.integers(0, 9 if k == "d1" else values, size)
            part["d0"] += np.uint64(2**64 - 60)
            part["id"], part["n"] = rng.integers(-50, 50, size), rng.integers(1, 4, size)
            parts.append(part)
        groups = {}
        for *key, i, n in (e for part in parts for e in part.tolist()):
            groups.setdefault(tuple(key), []).append((i, n))
        want = [(*key, best(i for i, _ in g), sum(n for _, n in g)) for key, g in sorted(groups.items())]
        assert merge_runs([sorted_run(part, keep) for part in parts], keep).tolist() == want


@pytest.mark.parametrize("light, keys", [(2000, 100_000), (10, 100_000), (0, 3)])
def test_join_of_hot_keys(spark, monkeypatch, light, keys):
    monkeypatch.setattr(common, "LIGHT_ROWS", light)
    monkeypatch.setattr(common, "HEAVY_KEYS", keys)
    rows = [(i, 0 if i % 3 else i % 50) for i in range(900)]
    left = spark.createDataFrame(rows, "row long, key long")
    right = left.groupBy("key").count().selectExpr("key", "count as n", "key * 7 as value").filter("key != 9")
    found = common.skew_join(left, right, ["key"], "n", len(rows)).select("row", "key", "value")
    assert sorted(map(tuple, found.collect())) == [(i, k, k * 7) for i, k in rows if k != 9]


def brute_lines(rows, least):
    strip = " \t\x0b\x0c\r\n"
    key = lambda x: x.strip(strip).translate(LOWER)
    seen = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            seen.setdefault(key(x), set()).add((i, t or ""))
    gone = {k for k, v in seen.items() if k and len(v) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in gone]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def test_line_dedup_equals_brute_force(spark, odd_docs):
    rng = random.Random(2)
    pool = ["Cookie notice", " cookie NOTICE\t", "", "  ", "a", "b\r", "B", "é line", "É line", *(f"own {i}" for i in range(300))]
    rows = [(i % 190, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for i in range(200)] + [(7, None), (None, "a\nb"), (None, "a\nb")]
    found = line_dedup(spark.createDataFrame(rows, DOCS).repartition(5), min_docs=10)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_lines(rows, 10)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = line_dedup(odd_docs, min_docs=3)
    assert set(found.columns) == {*odd_docs.columns, "n_dropped"}
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found.collect()], key=repr) == brute_lines(rows, 3)
    assert line_dedup(odd_docs.limit(0)).count() == 0


def test_line_dedup_of_long_documents_takes_linear_time(spark):
    """Ten documents of the same 50,000 lines, of which all but one's own go."""
    lines = "\n".join(f"line {i}" for i in range(50_000))
    rows = [(i, f"{lines}\nown {i}") for i in range(10)]
    start = time.monotonic()
    found = line_dedup(spark.createDataFrame(rows, DOCS).repartition(5), min_docs=10).collect()
    assert time.monotonic() - start < 60
    assert sorted(map(tuple, found)) == [(i, f"own {i}", 50_001, 50_000) for i in range(10)]


# -- near-duplicates -------------------------------------------------------------------------------------------------


def shingles(text, n):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_near(rows, n, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and (100 * both >= percent * len(a | b) or rows[i][0] == rows[j][0]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {(d, len(sets[i]), least[find(i)] if sets[i] else d, d == (least[find(i)] if sets[i] else d)) for i, (d, _) in enumerate(rows)}


def copies(rng, words, n, most):
    """Texts made of one by changing up to `most` words."""
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randrange(most + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("n", [2, 5])
def test_near_dedup_equals_brute_force(spark, n):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = [t for _ in range(30) for t in copies(rng, [word() for _ in range(rng.randrange(20, 120))], rng.randrange(1, 6), 3)]
    texts += copies(rng, [word() for _ in range(150)], 4 * BLOCK, 9)  # a group of many blocks, whose members differ by about the threshold
    texts += ["same text of five words"] * 30 + ["one", "ONE", "two words", "Two\x0bwords", "", " \n"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = near_dedup(spark.createDataFrame(rows, DOCS).repartition(7), n, 80)
    assert {tuple(r) for r in found.collect()} == brute_near(rows, n)


def test_near_dedup_finds_pairs_among_many_documents_of_the_same_passages(spark):
    """Any two documents have a similarity of about 0.45, made of what thousands share, and a few pairs one over 0.8."""
    rng = np.random.default_rng(8)
    slots = np.char.add("w", np.arange(800).astype(str)).reshape(400, 2)
    made = [slots[np.arange(400), (rng.random(400) > 0.745).astype(int)] for _ in range(5000)]
    for i in range(100):  # documents 5000 + i: copies of i with 10 % of the words replaced
        made.append(np.where(rng.permutation(400) < 40, np.char.add(f"x{i}-", np.arange(400).astype(str)), made[i]))
    rows = [(i, " ".join(w)) for i, w in enumerate(made)]
    found = near_dedup(spark.createDataFrame(rows, DOCS).repartition(8), 1, 80)
    assert {(r["doc_id"], r["component_id"]) for r in found.filter("NOT kept").collect()} == {(5000 + i, i) for i in range(100)}


def test_near_dedup_of_odd_rows(spark, odd_docs, no_docs):
    found = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_dedup(odd_docs, 2).collect()}
    assert found[1, 0] == (1, True) and found[2, 0] == (2, True) and found[3, 0] == (3, True)
    assert found[4, 4] == (4, True) and found[5, 4] == (4, False) and found[None, 4] == (None, True)
    assert near_dedup(odd_docs, 2).count() == odd_docs.count() and near_dedup(no_docs).count() == 0
    rows = [(9, "a b c d e f"), (9, "q r s t u v"), (3, "q r s t u v"), (5, "a b c d e f"), (6, "z")]
    assert {tuple(r) for r in near_dedup(spark.createDataFrame(rows, DOCS), 2).collect()} == brute_near(rows, 2)


def test_links_are_exact():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype(np.uint64) for _ in range(80)]
    i, j = links(np.arange(80), sets, 80)
    want = {(a, b) for a in range(80) for b in range(a + 1, 80) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want
    some = shingle_hashes("a b c a b c d", 2)
    assert len(some) == 4 and (_unpack(_pack(some)) == some).all()


def test_shingles_of_a_long_text_are_counted_in_full():
    n = 3_000_000  # at 40 bits about 4 of them would collide
    assert len(shingle_hashes(" ".join(map(str, range(n))), 1)) == n


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(2000, 2300)] + [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(120)] + [(7, 7)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    node, root = forest(*(np.array(x) for x in zip(*edges, strict=True)))
    assert found == dict(zip(node.tolist(), root.tolist(), strict=True))
    assert found[300] == 0 and found[2299] == 1000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
