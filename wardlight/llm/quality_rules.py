"""Quality rules: a decision list of threshold conjunctions, learned from labelled statistics by sequential covering.

Statistics of every whole text are counted in numpy, an Arrow batch at a time, in one pass without a shuffle. The
learner sees the statistics of at most `SAMPLE` labelled documents. It grows one rule after the other on two thirds of
them, adding the threshold with the best gain, prunes it on the last third, keeps it if it is right there nearly
always, and removes what it covers. The result is an ordered list of readable conditions on shares of words, characters
and lines, applied as one Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.llm.common import WHITE, Prefix, mix, slices, spread, word_table, words

#: Most labelled documents that the learner sees; the lowest hashes of their ids are taken.
SAMPLE = 20_000
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_letters", "n_upper", "n_shouts", "n_echoes", "n_short", "n_long", "n_digits")
STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

_WORD = word_table(WHITE)


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _UPPER, _SHOUT, _DIGIT = _class(SYMBOLS), _class(bytes(range(65, 91))), _class(b"!?"), _class(b"0123456789")
_LETTER = _class(bytes(range(65, 91)) + bytes(range(97, 123)))
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether an equal one stands before it, and whether there is any other equal one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later, shared = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return later, shared


def counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of `COUNTS` for the rows of one run of texts. Equal words and lines are told by 64-bit hashes."""
    n = len(offsets) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]
    starts, ends, rows = words(data, offsets, _WORD)
    lead, prefix = _LEAD[data], Prefix(data)
    hashes = prefix.hash(starts, ends)
    salt = rows.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)

    whole = np.flatnonzero(rows[2:] == rows[:-2]) if len(rows) > 2 else np.zeros(0, np.int64)
    triples = mix(mix(mix(hashes[whole] ^ salt[whole]) + hashes[whole + 1]) + hashes[whole + 2])
    again = whole[_repeats(triples)[1]]
    hit = np.zeros(len(rows), bool)
    for k in range(3):
        hit[again + k] = True

    breaks = np.flatnonzero(data == 10)
    firsts, lasts = np.sort(np.concatenate([offsets[:-1], breaks + 1])), np.sort(np.concatenate([breaks, offsets[1:]]))
    line = firsts[np.searchsorted(firsts, starts, "right") - 1]
    begins = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    line, line_rows = line[begins], rows[begins]
    line_end = lasts[np.searchsorted(lasts, line, "right")]
    twice = _repeats(mix(prefix.hash(line, line_end) ^ salt[begins]))[0]

    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])
    length = chars[ends] - chars[starts]
    echo = np.flatnonzero((hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])) + 1
    return [spread(rows, n), spread(rows, n, length), per_row(_SYMBOL[data]), spread(line_rows[twice], n),
            spread(rows[hit], n), spread(line_rows, n), per_row(_LETTER[data]), per_row(_UPPER[data]),
            per_row(_SHOUT[data]), spread(rows[echo], n), spread(rows[length <= 3], n), spread(rows[length > 12], n),
            per_row(_DIGIT[data])]


@F.arrow_udf(STATISTICS)
def statistics(text: pa.Array) -> pa.Array:
    """Counts of a text column; NULL and empty texts have zeros."""
    parts = [counts(*run) for run in slices(text)]
    columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(COUNTS))]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=list(COUNTS))


def _share(stats: Column, part: str, whole: str) -> Column:
    return stats[part] / F.greatest(stats[whole], F.lit(1))


#: What rules may compare with a threshold: a name, and the counts whose quotient it is.
FEATURES = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "echo_share": ("n_echoes", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "short_share": ("n_short", "n_words"),
    "long_share": ("n_long", "n_words"),
    "digits_per_word": ("n_digits", "n_words"),
}


def base_failed(stats: Column) -> Column:
    """Fewer than 50 words, or more than half of the words in windows that come again."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class Rule:
    """Reject where every (feature, above, threshold) holds: the feature is above the threshold, or at most that."""
    conditions: tuple[tuple[str, bool, float], ...]
    right: int
    wrong: int

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for name, above, threshold in self.conditions:
            value = _share(stats, *FEATURES[name])
            out &= value > threshold if above else value <= threshold
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>' if above else '<='} {t:.6g}" for f, above, t in self.conditions)


def _covers(values: np.ndarray, names: Sequence[str], conditions) -> np.ndarray:
    out = np.ones(len(values), bool)
    for name, above, threshold in conditions:
        column = values[:, names.index(name)]
        out &= column > threshold if above else column <= threshold
    return out


def _grow(values: np.ndarray, bad: np.ndarray, names: Sequence[str], longest: int) -> list:
    """Adds the threshold with the best information gain until the rule covers no good document."""
    conditions, held = [], np.ones(len(values), bool)
    while len(conditions) < longest and (held & ~bad).any():
        p0, n0 = (held & bad).sum(), (held & ~bad).sum()
        best, around = (0.0, None), None
        for k, name in enumerate(names):
            column = values[held, k]
            marks = np.unique(np.quantile(column, np.linspace(0, 1, 51)))
            for above in (True, False):
                gain, at = _best_cut(column, bad[held], (marks[1:] + marks[:-1]) / 2, above, p0, n0)
                if gain > best[0] + 1e-9:
                    best, around = (gain, (name, above, float((marks[at] + marks[at + 1]) / 2))), (column, marks[max(at - 1, 0)], marks[min(at + 2, len(marks) - 1)])
        if best[1] is None:
            break
        column, low, high = around
        fine = np.unique(column[(column >= low) & (column <= high)])
        name, above, _ = best[1]
        gain, at = _best_cut(column, bad[held], (fine[1:] + fine[:-1]) / 2, above, p0, n0)
        if gain > best[0]:
            best = gain, (name, above, float((fine[at] + fine[at + 1]) / 2))
        conditions.append(best[1])
        held &= _covers(values, names, [best[1]])
    return conditions


def _best_cut(column: np.ndarray, bad: np.ndarray, cuts: np.ndarray, above: bool, p0: int, n0: int) -> tuple[float, int]:
    """The best information gain of a threshold, and which of the cuts (in order) it is."""
    if not len(cuts):
        return 0.0, 0
    place = np.searchsorted(cuts, column, "left")  # so many cuts are below the value
    p = np.cumsum(np.bincount(place[bad], minlength=len(cuts) + 1))[:-1]
    n = np.cumsum(np.bincount(place[~bad], minlength=len(cuts) + 1))[:-1]
    if above:
        p, n = p0 - p, n0 - n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
    at = int(np.argmax(gain))
    return float(gain[at]), at


def learn(values: np.ndarray, bad: np.ndarray, names: Sequence[str], precision: float = 0.99, held_precision: float = 0.95,
          least: int = 5, longest: int = 4, most_rules: int = 30) -> list[Rule]:
    """The ordered rules that reject. Rows alternate, two to grow on and one to prune on.

    A rule stays if at least `least` bad rows in all are covered, and of what it covers `precision` is bad on all rows
    and `held_precision` on the rows it was pruned on. Without bad rows, or rows at all, there are no rules and everything is kept.
    """
    rules, left, growing = [], np.ones(len(values), bool), np.ones(len(values), bool)
    prune = np.arange(len(values)) % 3 == 2
    while len(rules) < most_rules:
        grow = left & growing & ~prune
        if (bad & grow).sum() < least:
            break
        conditions = _grow(values[grow], bad[grow], names, longest)
        if not conditions:
            break
        best, score = conditions, -1.0
        for k in range(len(conditions), 0, -1):
            covered = _covers(values, names, conditions[:k]) & left
            p, n = (covered & prune & bad).sum(), (covered & prune & ~bad).sum()
            if p + n and (p - n) / (p + n) >= score:
                best, score = conditions[:k], (p - n) / (p + n)
        covered = _covers(values, names, best) & left
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if p < least or score < 2 * held_precision - 1 or p < precision * (p + n):
            if not (covered & grow).any():
                break
            growing &= ~(covered & bad)  # another rule is sought for the rest
            continue
        rules.append(Rule(tuple(best), p, n))
        left &= ~covered
    return rules


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Feature values and `bad` of at most `sample` labelled documents, in the order of a hash of their ids.

    Labels that are NULL or contradict each other are left out, and a document that repeats its id counts once.
    """
    chosen = (labels.where("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
              .where("low = high").select("doc_id", (F.col("low") == 0).alias("bad"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    seen = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("s", statistics("text"))
    return (seen.groupBy("doc_id", "bad").agg(F.min("s").alias("s"))
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .select("bad", *[_share(F.col("s"), *FEATURES[f]).alias(f) for f in FEATURES]))


def learn_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, precision: float = 0.99) -> list[Rule]:
    """Rules from the labelled documents among `docs` (doc_id, text) by `labels` (doc_id, quality, 0 for bad)."""
    table = labelled(docs, labels, sample).toPandas()
    names = list(FEATURES)
    return learn(table[names].to_numpy(float).reshape(-1, len(names)), table["bad"].to_numpy(bool), names, precision)


def verdict(stats: Column, rules: Sequence[Rule]) -> Column:
    """The decision list as a conditional expression: false at the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    out = F.when(rules[0].column(stats), False)
    for rule in rules[1:]:
        out = out.when(rule.column(stats), False)
    return out.otherwise(True)


def judge(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """doc_id, the counts, `base_failed` and `kept` for every row of `docs`; other columns are left out.

    NULL and empty texts have no words and so fail the base. Rows are judged one by one: repeated rows all stay, and
    an empty table gives no rows.
    """
    stats = F.col("stats")
    return (docs.select("doc_id", statistics("text").alias("stats"))
            .select("doc_id", *[stats[c].alias(c) for c in COUNTS], base_failed(stats).alias("base_failed"),
                    (~base_failed(stats) & verdict(stats, rules)).alias("kept")))


def keep(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows of `docs` that neither the base nor a rule rejects, with their columns."""
    mark = "__stats__"
    stats = F.col(mark)
    return docs.withColumn(mark, statistics("text")).where(~base_failed(stats) & verdict(stats, rules)).drop(mark)
