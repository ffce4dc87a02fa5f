"""Vectors, periodic runs and the manifest against brute force."""

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from wardlight.llm import embedding_dedup as vectors
from wardlight.llm import merkle, periodic

WORD = re.compile("[^\x20\x09-\x0d]+")


# -- periodic runs

def plain_runs(w, shortest=12):
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(shortest, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((i, e - i, q) for (i, e), q in found.items())


def plain_words(doc_id, text, cycle):
    w = WORD.findall(text or "")
    if cycle and w and doc_id is not None and crc32(str(doc_id).encode()) % 10 == 0:
        g = crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def periodic_texts():
    rnd = random.Random(5)
    texts = [None, "", "  \n ", "a " * 300, "é ü " * 40, "a b", " ".join("abaababaabaababaababa" * 12)]
    for k in range(60):
        alphabet = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 30, 400]))]
        w = rnd.choices(alphabet, k=rnd.choice([3, 11, 12, 50, 400]))
        for _ in range(rnd.choice([0, 1, 3])):
            unit = rnd.choices(alphabet, k=rnd.choice([1, 2, 5, 20]))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = (unit * 12)[:rnd.choice([11, 12, 13, 60])]
        texts.append(rnd.choice([" ", "\n", "\t ", "\x0b"]).join(w))
    return texts + [texts[20]] * 2


@pytest.mark.parametrize("cycle", [False, True])
def test_runs_against_brute_force(spark, cycle):
    texts = periodic_texts()
    rows = [(k if k else None, t, k) for k, t in enumerate(texts)] + [(7, texts[9], 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, runs int").repartition(3)
    out = periodic.runs(table, cycle=cycle).collect()
    assert len(out) == len(rows)
    want = Counter()
    for doc_id, text, _ in rows:
        w = plain_words(doc_id, text, cycle)
        runs = plain_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want[doc_id, len(w), tuple(runs), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in out) == want


def test_runs_of_random_numbers():
    rnd = np.random.default_rng(3)
    for k in range(150):
        n, letters = int(rnd.integers(1, 120)), int(rnd.integers(1, 4))
        codes = rnd.integers(0, letters, n)
        start, end, period = periodic.word_runs(codes, np.zeros(n, np.int64), 4)
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == plain_runs(codes.tolist(), 4)


def test_runs_of_a_long_text():
    codes = np.zeros(60_000, np.int64)
    codes[20_000:40_000] = np.arange(20_000) % 7 + 1
    start, end, period = periodic.word_runs(codes, np.zeros(len(codes), np.int64))
    assert list(zip(start.tolist(), end.tolist(), period.tolist())) == [(0, 20_000, 1), (20_000, 40_000, 7), (40_000, 60_000, 1)]


def test_run_report(spark):
    words = ["x"] * 13 + ["y"] + ["a", "b"] * 8 + ["z"]
    table = spark.createDataFrame([(1, " ".join(words)), (2, "a b c"), (3, None)], "doc_id bigint, text string")
    one, two, three = periodic.report(periodic.runs(table)).orderBy("doc_id").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert one[:6] == (1, 2, 14, 16, 2, 8000)
    assert one.runs_sha256 == sha("0,13,1\n14,16,2\n") and one.collapsed_sha256 == sha("x y a b z")
    assert two[:6] == (2, 0, None, None, None, None) and two.runs_sha256 == sha("") and two.collapsed_sha256 == sha("a b c")
    assert three[1:6] == (0, None, None, None, None) and three.collapsed_sha256 == sha("")
    assert periodic.report(periodic.runs(table.where("false"))).count() == 0


# -- manifest

def plain_leaf(row):
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return hashlib.sha256("".join(map(text, row)).encode()).hexdigest()


def plain_proofs(leaves):
    """The root and, per leaf, the siblings on its way as (before, after)."""
    join = lambda nodes: "".join(nodes)
    paths, level, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, p in enumerate(place):
            first = p // 3 * 3
            paths[k].append((join(level[first:p]), join(level[p + 1:first + 3])))
        level = [hashlib.sha256(join(level[i:i + 3]).encode()).hexdigest() for i in range(0, len(level), 3)]
        place = [p // 3 for p in place]
    return level[0], paths


def plain_manifest(rows):
    key = lambda v: (v is not None, v if v is not None else 0)
    ordered = sorted(rows, key=lambda r: (key(r[0]), plain_leaf(r)))
    by = {}
    for r in ordered:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: plain_proofs([plain_leaf(r) for r in by[s]]) for s in names}
    root, upper = plain_proofs([inner[s][0] for s in names])
    for s, above in zip(names, upper):
        subroot, paths = inner[s]
        for r, path in zip(by[s], paths):
            now = r if r[0] is None or crc32(str(r[0]).encode()) % 2 else (*r[:4], r[4] and r[4].replace("\n", ""))
            node = plain_leaf(now)
            for before, after in path + above:
                node = hashlib.sha256((before + node + after).encode()).hexdigest()
            proof = hashlib.sha256("".join(a + b for a, b in path + above).encode()).hexdigest()
            yield (r[0], plain_leaf(r), subroot, root, proof, node, node == root)


def manifest_rows():
    rnd = random.Random(2)
    sizes = {"": 1, "a": 2, "B": 3, "é": 4, None: 10, "z": 82, "hot": 250, "one": 1, "ü": 9}
    rows = [(0, s, rnd.choice(["en", None]), rnd.choice([7, None]), rnd.choice([None, "", "x\ny", "é\n\nü", "no line"]))
            for s, n in sizes.items() for _ in range(n)]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    return rows + [rows[3], rows[200], (200, *rows[201][1:]), (None, "a", None, None, "q\n"), (None, None, None, None, None)]


def test_manifest_against_brute_force(spark):
    rows = manifest_rows()
    table = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, "
                                  "lo int, digest int").repartition(5)
    out = merkle.verified(merkle.manifest(table))
    got = [(r.doc_id, r.leaf, r.subroot, r.root, hashlib.sha256(r.proof.encode()).hexdigest(), r.folded_root, r.verified)
           for r in out.withColumn("proof", merkle.proof(out.path)).collect()]
    assert Counter(got) == Counter(plain_manifest(rows))
    assert {g[-1] for g in got} == {True, False}
    assert merkle.verified(merkle.manifest(table.where("false"))).count() == 0


def test_a_single_document_is_the_root(spark):
    table = spark.createDataFrame([(1, "s", "en", 1, "t")], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    one = merkle.verified(merkle.manifest(table)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.path == [] and one.verified


# -- vectors

def plain_links(rows, threshold):
    ok = [v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for _, v, label in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / abs(a).max(), b / abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    up[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], n[i], least.get(find(i)), r[0] is not None and least.get(find(i)) == r[0]) for i, r in enumerate(rows))


def vector_rows(n=350, size=24, seed=1):
    rnd = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        if rows and rnd.random() < 0.6:
            v = np.array(rows[rnd.integers(len(rows))]) * rnd.choice([1.0, 3.0])
            rows.append((v + rnd.normal(size=size) * rnd.choice([0, 0.05, 0.3, 0.42])).astype(np.float32).tolist())
        else:
            rows.append(rnd.normal(size=size).astype(np.float32).tolist())
    rows = [(v, int(rnd.integers(2))) for v in rows]
    odd = [(None, 0), ([0.0] * size, 0), (rows[0][0], None), ([float("nan")] * size, 1), ([1.0, None], 0), ([], 0),
           ([1.0], 0), ([2.0], 0), ([-2.0], 0), ([1.0, 1.0], 1), ([1.0, 1.1], 1), ([1e-30, 1e-30], 1), rows[4], rows[4]]
    rows += odd
    return [(1000 - k, v, label) for k, (v, label) in enumerate(rows)] + [(None, *rows[4]), (None, [3.0, -9.0], 1), (996, *rows[4])]


@pytest.mark.parametrize("bucket,block", [(8192, 4096), (8192, 37), (16, 20)])
def test_vectors_against_brute_force(spark, bucket, block):
    rows = vector_rows()
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, node int").repartition(4)
    out = vectors.near_duplicates(table, bucket=bucket, block=block).collect()
    stored = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert Counter(map(tuple, out)) == plain_links(stored, 0.93)


def test_vectors_of_an_empty_table(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<double>, label int")
    assert vectors.near_duplicates(table).count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rnd = np.random.default_rng(7)
    base = vectors.directions(rnd.normal(size=(4000, 64)))
    other = vectors.directions(rnd.normal(size=(4000, 64)))
    near = vectors.directions(other - (other * base).sum(1, keepdims=True) * base)
    near = 0.93 * base + np.sqrt(1 - 0.93 ** 2) * near
    codes, factors = vectors.encode(base)
    estimates = (vectors.signs(codes, 64) * (near @ vectors.rotation(64).T)).sum(1) / factors
    assert abs(estimates.mean() - 0.93) < 0.01
    bounds = vectors.lower_bounds(factors, 64, 0.93)
    assert (estimates >= bounds).all() and bounds.mean() > 0.7


def test_tables_for_large_labels_find_nearly_all():
    rnd = np.random.default_rng(8)
    a = vectors.directions(rnd.normal(size=(3000, 64)))
    b = vectors.directions(rnd.normal(size=(3000, 64)))
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * vectors.directions(b - (a * b).sum(1, keepdims=True) * a)
    for bits in (1, 4, 9):
        tables = vectors.tables_for(bits)
        sides = [(x @ vectors.hyperplanes(64, bits, tables) > 0).reshape(3000, tables, bits) for x in (a, b)]
        assert (sides[0] == sides[1]).all(axis=2).any(axis=1).all()
    assert vectors.bits_for(8192) == 0 and vectors.bits_for(8193) == 1 and vectors.bits_for(10 ** 9) == 17
