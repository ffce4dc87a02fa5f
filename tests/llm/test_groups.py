"""SimHash groups, components, mixing and line groups against brute force."""

import random
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from wardlight.llm import graph, line_dedup, mixing, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def plain_fingerprint(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}é" if k % 5 == 0 else f"W{k}" for k in range(400)]
    base = [" ".join(rnd.choices(vocabulary, k=rnd.choice([3, 40, 150]))) for _ in range(40)]
    texts = list(base)
    for t in base:
        words = t.split(" ")
        for _ in range(rnd.choice([0, 1, 3])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    return texts + [None, "", " \n ", "one", "two", "one two", base[0].upper(), base[0] + "\n"] + [base[1]] * 30


def test_components_of_fingerprints(spark):
    texts = corpus()
    rows = [(k, t, 0) for k, t in enumerate(texts)] + [(3, texts[3], 0), (None, texts[5], 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, bits int").repartition(4)
    out = simhash.components(table)
    found = [(r.doc_id, r.fp, r.component_id) for r in out.select("doc_id", simhash.hexadecimal(out.bits).alias("fp"), "component_id").collect()]
    prints = [plain_fingerprint(t, 3) for t in texts]
    union = Union(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                union.join(i, j)
    expected = [(k, f"{p:016x}", union.find(k)) for k, p in enumerate(prints)]
    assert Counter(found) == Counter([*expected, expected[3], (None, *expected[5][1:])])
    assert simhash.components(table.limit(0)).count() == 0


def test_balls_meet(spark):
    rnd = random.Random(2)
    pairs = []
    for _ in range(60):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.choice([1, 2, 3])):
            b ^= 1 << bit
        pairs.append(tuple(n - (1 << 64) if n >> 63 else n for n in (a, b)))
    table = spark.createDataFrame(pairs, "a bigint, b bigint")
    from pyspark.sql import functions as F
    met = table.where(F.size(F.array_intersect(simhash.ball_keys(F.col("a")), simhash.ball_keys(F.col("b")))) > 0)
    assert met.count() == len(pairs)


def test_hundreds_in_one_bucket(spark):
    """A dense ball, whose members share buckets, is one component; another far from it stays apart."""
    middle = 0x1234567890ABCDEF
    near = [middle] + [middle ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    far = [0x0FEDCBA987654321, 0x0FEDCBA987654321 ^ 7]
    table = spark.createDataFrame([(n,) for n in near + far], "bits bigint")
    roots = {r.node: r.root for r in simhash.linked_fingerprints(table).collect()}
    assert {roots[n] for n in near} == {min(near)} and {roots[n] for n in far} == {min(far)}


def test_one_of_each(spark):
    texts = corpus(3)
    rows = [(k if k % 9 else None, t, k % 2) for k, t in enumerate(texts)] + [(4, texts[4], 0), (4, texts[4], 0), (4, texts[4], 5), (5, "lone words here", 1)] * 2
    rows += [(None, "only without an id", 1)] * 2
    table = spark.createDataFrame(rows, "doc_id bigint, text string, bits int").repartition(4)
    prints = [plain_fingerprint(t, 3) for _, t, _ in rows]
    union = Union(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                union.join(i, j)
    smallest = {}
    for k, (doc_id, _, _) in enumerate(rows):
        root = union.find(k)
        smallest[root] = min(smallest.get(root, (True, 0)), (doc_id is None, doc_id or 0))
    out = simhash.one_of_each(table)
    assert out.columns == table.columns
    found = Counter()
    for r in out.collect():
        k = rows.index(tuple(r))
        found[union.find(k)] += 1
        assert smallest[union.find(k)] == (r.doc_id is None, r.doc_id or 0)
    assert found == Counter(smallest.keys())
    assert simhash.one_of_each(table.limit(0)).count() == 0


def test_graph(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(k, 100) for k in range(101, 160)] + [(200, 200), (300, 299), (299, 300), (None, 5)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 299: 299, 300: 299}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- mixing

def plain_schedule(weights):
    period, done, out = sum(weights), [0] * len(weights), []
    for slot in range(period):
        ready = [(-(-(d + 1) * period // w), i) for i, (d, w) in enumerate(zip(done, weights)) if d < w and d * period // w <= slot]
        i = min(ready)[1]
        out.append((i, done[i]))
        done[i] += 1
    return out


def test_schedule(spark):
    for weights in ([5, 3, 2, 1, 1, 1], [1], [50] + [1] * 20, [7, 7, 3]):
        names = [f"s{k:03d}" for k in range(len(weights))]
        sources = spark.createDataFrame([(n, w, 10) for n, w in zip(names, weights)], "source string, weight int, rows bigint")
        found = [(names.index(r.source), r.kth) for r in sorted(mixing.schedule(sources).collect(), key=lambda r: r.slot)]
        assert found == plain_schedule(weights)
        period = sum(weights)
        count = [0] * len(weights)
        for slot, (i, _) in enumerate(found, 1):
            count[i] += 1
            assert all(abs(c - w * slot / period) < 1 for c, w in zip(count, weights))


def test_schedules_of_any_weights(spark):
    rnd = random.Random(12)
    for _ in range(12):
        weights = rnd.choices([1, 1, 1, 2, 3, 7], k=rnd.randrange(1, 12)) if rnd.random() < 0.7 else rnd.choices([2, 2, 2, 5, 9], k=6)
        names = [None, *(f"s{k:03d}" for k in range(1, len(weights)))]
        sources = spark.createDataFrame(list(zip(names, weights)), "source string, weight int").repartition(3)
        found = sorted(mixing.schedule(sources).collect(), key=lambda r: r.slot)
        assert [(names.index(r.source), r.kth) for r in found] == plain_schedule(weights)


def test_many_sources_and_large_weights(spark):
    """No limit on sources or the period; at every slot each source is less than a block off its share."""
    rows = [(f"h{k:06d}", 1) for k in range(50_000)] + [("big", 900), ("mid", 77), ("h00", 3)]
    out = mixing.schedule(spark.createDataFrame(rows, "source string, weight int")).toPandas().sort_values("slot")
    period = 50_980
    assert out.slot.tolist() == list(range(period)) and set(out.period) == {period}
    for source, w in rows[-3:] + rows[:50_000:9_999]:
        mine = out[out.source == source].slot.to_numpy()
        k = np.arange(w)
        assert (mine >= k * period // w).all() and (mine < -(-(k + 1) * period // w)).all()
    heavy = spark.createDataFrame([("a", 20_001), ("b", 29_999), ("c", 1)], "source string, weight int")
    out = mixing.schedule(heavy).toPandas().sort_values("slot")
    for source, w in (("a", 20_001), ("b", 29_999), ("c", 1)):
        done = np.cumsum(out.source == source)
        assert (abs(done - w * np.arange(1, len(out) + 1) / 50_001) < 1).all()


def test_mix(spark):
    rnd = random.Random(4)
    rows = [(k, rnd.choice(["a", "a", "a", "b", "c", None]), "t", 0) for k in range(900)] + [(5, "a", "t", 0), (None, "b", None, 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, source string, text string, position int").repartition(5)
    out = mixing.mix(table, {"a": 2, "b": 3, "gone": 9}, block_rows=10).collect()
    assert sorted(r.position for r in out) == list(range(902))
    assert Counter((r.doc_id, r.source) for r in out) == Counter((i, s) for i, s, *_ in rows)
    sizes = Counter(s for _, s, *_ in rows)
    weights = {"a": 2, "b": 3, "c": 1, None: 1}
    seen = Counter()
    for r in sorted(out, key=lambda r: r.position):
        seen[r.source] += 1
        if all(seen[s] + 30 < sizes[s] for s in sizes):  # while every source has rows left
            for s, w in weights.items():
                assert abs(seen[s] - sum(seen.values()) * w / 7) < 2 * 10
    ordered = mixing.in_order(table, {"a": 2, "b": 3}, block_rows=10)
    assert ordered.columns == table.columns and ordered.count() == 902
    assert mixing.mix(table.limit(0), {}).count() == 0


# -- lines

def test_line_groups(spark):
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)] + ["the"] * 60
    lines = [" ".join(rnd.choices(vocabulary, k=rnd.choice([1, 4, 12, 30]))) for _ in range(60)]
    for line in list(lines):
        words = line.split(" ")
        words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        lines += [" ".join(words), line.upper(), "  " + line]
    rnd.shuffle(lines)
    texts = ["\n".join(lines[k:k + 6]) for k in range(0, len(lines), 6)] + [None, "", "\n\n", "the", "x\n\nx", "q " * 5000]
    rows = [(k, t, "c") for k, t in enumerate(texts)] + [(2, texts[2], "c"), (None, texts[4], "c")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, line_no string").repartition(4)
    members, sets = [], {}
    for i, t, _ in rows:
        for n, line in enumerate(t.split("\n") if t is not None else []):
            words = frozenset(WORD.findall(line.lower()))
            if words:
                place = (-1 if i is None else i, n)
                members.append((place, words))
                sets[words] = min(sets.get(words, place), place)
    every = list(sets)
    union = Union(range(len(every)))
    for i in range(len(every)):
        for j in range(i):
            both = len(every[i] & every[j])
            if both >= 0.8 * (len(every[i]) + len(every[j]) - both) - 1e-9:
                union.join(i, j)
    first = {}
    for k, words in enumerate(every):
        root = union.find(k)
        first[root] = min(first.get(root, (1 << 60, 0)), sets[words])
    number = {w: k for k, w in enumerate(every)}
    expected = Counter((p, first[union.find(number[w])], p > first[union.find(number[w])]) for p, w in members)
    null = lambda i: -1 if i is None else i
    found = Counter(((null(r.doc_id), r.line_no), (null(r.group_doc), r.group_line), r.removed) for r in line_dedup.line_groups(table).collect())
    assert found == expected
    gone = {p for p, _, removed in expected if removed}
    out = line_dedup.dedup_lines(table)
    assert out.columns == table.columns
    for r in out.collect():
        t = next(t for i, t, _ in rows if i == r.doc_id)
        assert r.text == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (null(r.doc_id), n) not in gone))
    assert line_dedup.line_groups(table.limit(0)).count() == 0


def test_line_links(spark):
    """Lines are removed for a match before them, not for a chain of matches; all links are counted, also at a hot word."""
    words = [f"c{k}" for k in range(12)]
    drift = [" ".join([f"d{j}" for j in range(k)] + words[k:]) for k in range(3)]  # 0~1, 1~2; 0 and 2 share 10 of 14
    family = [" ".join([f"e{j}" for j in range(20)] + [f"f{k}"]) for k in range(30)]
    texts = [drift[0], drift[2], drift[1], "alone", *family]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    sets = [frozenset(t.split()) for t in texts]
    alike = [[i for i in range(len(texts)) if i != k and 10 * len(sets[i] & sets[k]) >= 8 * len(sets[i] | sets[k])] for k in range(len(texts))]
    assert [len(a) for a in alike] == [1, 1, 2, 0] + [29] * 30
    for part_entries in (line_dedup.PART_ENTRIES, 7):
        out = {r.doc_id: r for r in line_dedup.line_groups(table, part_entries=part_entries).collect()}
        assert [out[k].links for k in range(len(texts))] == [len(a) for a in alike]
        assert [out[k].match_doc for k in range(len(texts))] == [min([k, *a]) for k, a in enumerate(alike)]
        assert [k for k in range(len(texts)) if out[k].removed] == [2, *range(5, 34)]
        assert [out[k].group_doc for k in range(5)] == [0, 0, 0, 3, 4]
    assert line_dedup.dedup_lines(table).where("doc_id = 1").first().text == drift[2]


def test_lines_meet_at_the_first_words_they_share(spark):
    """Ten words need nine in common, so no pair has its first common word behind the second; NULL-free words sort as numbers."""
    entries = spark.createDataFrame([(i, j) for i in range(3) for j in range(3)], "i int, j int").select("i", "j", *[
        F.struct(F.lit(10).alias("n"), F.col(p).alias("pos"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")).alias(s)
        for s, p in (("a", "i"), ("b", "j"))])
    assert sorted((r.i, r.j) for r in entries.where(line_dedup._likely("a", "b", 0.8)).collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    words = spark.range(1).select(F.array(F.lit(5).cast("long")).alias("words"), F.array(F.lit(0)).alias("ranks"))
    assert not words.select(line_dedup._ordered(F.col("words"), F.col("ranks")).alias("o")).schema["o"].dataType.containsNull


def test_line_links_of_long_lines(spark):
    """Lines shorter and longer than what decides the parities' slots, on both sides of the similarity."""
    texts = [" ".join([f"l{k}" for k in range(n)] + [f"x{n}-{c}-{j}" for j in range(c)]) for n in (50, 58, 64, 66, 120, 150) for c in (0, 1, 6, 13, 20)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [frozenset(t.split()) for t in texts]
    want = [sum(10 * len(x & y) >= 8 * len(x | y) for y in sets) - 1 for x in sets]
    out = {r.doc_id: r.links for r in line_dedup.line_groups(table).collect()}
    assert [out[k] for k in range(len(texts))] == want and len(set(want)) > 3
