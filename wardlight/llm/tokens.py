"""Token ids as wavelet matrices, one for each shard of documents.

`write_shards` tokenizes whole texts, sorts documents by id over the cluster and writes shards of consecutive
documents. A shard is one row of a Parquet file: document ids and lengths, and the ids of its tokens as a wavelet
matrix. That is one plane of bits for each bit of an id, highest first; in each plane tokens stand in the order that
sorting by the bits before it leaves, zeros first. With a running count of ones for every 512 bits, `Shard` gives the
token at a place, counts a token up to a place, and finds its k-th place, each in one step per plane, from the packed
planes alone. `decode` turns planes back into ids, a plane at a time.

The text shuffles once. Tokenizing happens behind that shuffle, so a lost task repeats only its own documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.common import lower_ascii, slices, word_table, words

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: A shard is closed by the document that reaches this many ids.
SHARD_IDS = 1_000_000
BLOCK_BITS = 512
#: Texts are encoded in runs of about so many bytes.
RUN_BYTES = 4 << 20
#: Most bytes of pieces and ids in a memory of a worker. A full one is kept beside the next, which takes over what is met
#: again, so pieces in use are not learned anew.
REMEMBERED_BYTES = 32 << 20
_PIECE = word_table(b" \n")
#: Marks that may stand behind a word in a piece: ASCII without letters, digits and white space.
_PIECE = word_table(b" \n")
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SMALL, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_SMALL[97:123] = _MARK[list(MARKS)] = True
SHARDS = ("part int, seq int, n_before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, bits int, "
          "planes array<binary>, ranks array<binary>, zeros array<bigint>")


def _gather(flat: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(first - before, lengths) + np.arange(int(lengths.sum()))]


class _Memory:
    """Pieces and their ids, looked up and added many at a time."""

    def __init__(self):
        self.pieces = pa.array([], pa.large_binary())
        self.bounds, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.pieces)

    @property
    def held(self) -> int:
        return self.pieces.nbytes + self.bounds.nbytes + self.ids.nbytes

    def find(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece, -1 for one that is not here."""
        return np.array(pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1))

    def add(self, pieces: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The places of new pieces."""
        n = len(self)
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        return np.arange(n, len(self))

    def spans(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of pieces begin, and how many they are."""
        first = self.bounds[places]
        return first, self.bounds[places + 1] - first


class Encoder:
    """Ids of whole texts by a tokenizer of the tokenizers library, as 32-bit numbers.

    The tokenizer splits at white space and lower-cases, so the ids of a text are those of its pieces between blanks and
    line breaks, one after the other. Only pieces that hold `<|`, with which added tokens begin, keep their capitals: added
    tokens are looked for before lower-casing. Marks behind a-z are a piece of their own. Pieces of a run of texts are
    numbered, so each is looked up once, and ids are remembered. A new piece of other letters, with marks behind it, is put
    together from both; letters that no normalisation changes go to the library's model at once, many at a time, all else
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.largest = max(vocabulary.values())
        self.ends = np.zeros(self.largest + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # a byte that prints stands for itself, the others for characters from 256 on, in order
        printed = {ord(c) for c in ByteLevel.alphabet() if ord(c) < 256}
        self.letters = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in printed)}
        self.known, self.older = _Memory(), _Memory()

    def _letters(self, stem: bytes) -> str | None:
        """A word of small letters as the model takes it; None if it is no such word."""
        text = stem.decode()
        if stem.isalpha() and stem.islower():
            return text
        # letters up to U+024F are letters in every version of Unicode
        if text.isalpha() and max(text) < "\u0250" and text == text.lower() and is_normalized("NFC", text):
            return stem.decode("latin-1").translate(self.letters)
        return None

    def _learn_words(self, words: dict[bytes, str], known: dict[bytes, bytes]) -> list[bytes]:
        """Puts the ids of words of letters into `known`; gives back those that the ends of words don't tell apart."""
        stems, missed = list(words), []
        groups = [stems[k:k + 256] for k in range(0, len(stems), 256)]
        for group, e in zip(groups, self.plain.encode_batch_fast([" ".join([words[w] for w in g]) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                raw, begin = ids.tobytes(), 0
                for stem, cut in zip(group, (4 * cuts).tolist()):
                    known[stem] = raw[begin:cut]
                    begin = cut
            else:
                missed += group
        return missed

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as bytes."""
        known, words, other, parts = {b"": b""}, {}, set(), []
        for piece in pieces:
            stem = piece.rstrip(MARKS)
            if stem not in known and stem not in words:
                text = self._letters(stem)
                if text is None:
                    other.add(piece)
                    continue
                words[stem] = text
            if len(stem) < len(piece):
                tail = piece[len(stem):]
                parts.append((piece, stem, tail))
                other.add(tail)
        other.update(self._learn_words(words, known))
        single = list(other)
        for piece, e in zip(single, self.tokenizer.encode_batch_fast([p.decode() for p in single], add_special_tokens=False)):
            known[piece] = np.array(e.ids, np.uint32).tobytes()
        for piece, stem, tail in parts:
            known[piece] = known[stem] + known[tail]
        return [known[p] for p in pieces]

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where different pieces stand in the memory; new ones are learned."""
        at = self.known.find(pieces)
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at
        if self.known.held > REMEMBERED_BYTES:
            self.older, self.known = self.known, _Memory()
            missing = np.arange(len(pieces))
        wanted = pieces.take(pa.array(missing))
        places = self.older.find(wanted)
        old = places >= 0
        first, lengths = self.older.spans(places[old])
        at[missing[old]] = self.known.add(wanted.filter(pa.array(old)), lengths, _gather(self.older.ids, first, lengths))
        new = wanted.filter(pa.array(~old))
        found = self._learn(new.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at[missing[~old]] = self.known.add(new, lengths, np.frombuffer(b"".join(found), np.uint32))
        return at

    def encode_run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of UTF-8 bytes, one after the other, and how many each row has."""
        n = len(offsets) - 1
        starts, ends, rows = words(data, offsets, _PIECE)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        packed = data[_PIECE[data]]
        lowered = lower_ascii(packed)
        marks = np.flatnonzero((packed[:-1] == 0x3C) & (packed[1:] == 0x7C))  # <|
        for w in np.unique(np.searchsorted(bounds, marks, "right") - 1).tolist():
            lowered[bounds[w]:bounds[w + 1]] = packed[bounds[w]:bounds[w + 1]]
        bounds, rows = _marks_apart(lowered, bounds, rows)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(bounds), pa.py_buffer(lowered)]).dictionary_encode()
        places = self._places(column.dictionary)
        first, lengths = self.known.spans(places)
        number = column.indices.to_numpy()
        per_piece = lengths[number]
        return _gather(self.known.ids, first[number], per_piece), np.bincount(rows, per_piece, n).astype(np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text in UTF-8."""
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        ids, counts = self.encode_run(np.frombuffer(b"".join(texts), np.uint8), offsets)
        return np.split(ids, np.cumsum(counts)[:-1])


def _marks_apart(data: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and rows of pieces, where words of a-z with marks behind them are two."""
    marked = np.flatnonzero(_MARK[data[bounds[1:] - 1]])
    small, mark = (np.concatenate([[0], np.cumsum(t[data], dtype=np.int32)]) for t in (_SMALL, _MARK))
    begin, end = bounds[marked], bounds[marked + 1]
    letters = small[end] - small[begin]
    cut = begin + letters
    # as many letters as stand in front, marks alone behind
    parted = (letters > 0) & (small[cut] - small[begin] == letters) & (mark[end] - mark[cut] == end - cut)
    again = np.ones(len(rows), np.int64)
    again[marked[parted]] = 2
    return np.insert(bounds, marked[parted] + 1, cut[parted]), np.repeat(rows, again)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder, whose remembered words serve all its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def build(ids: np.ndarray, bits: int) -> tuple[list[bytes], list[bytes], list[int]]:
    """Planes (packed, lowest bit of a byte first), ones before every block, and the zeros of every plane."""
    planes, ranks, zeros = [], [], []
    current = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        ones = (current >> level & 1).astype(bool)
        packed = np.packbits(ones, bitorder="little")
        planes.append(packed.tobytes())
        ranks.append(_block_ranks(packed).tobytes())
        # compress has no branch for each token, which a mask as index has: bits of ids are as good as random
        low = current.compress(~ones)
        zeros.append(len(low))
        current = np.concatenate([low, current.compress(ones)])
    return planes, ranks, zeros


def _block_ranks(packed: np.ndarray) -> np.ndarray:
    size = BLOCK_BITS // 8
    padded = np.zeros(-(-max(len(packed), 1) // size) * size, np.uint8)
    padded[:len(packed)] = packed
    ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, size // 8).sum(1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)


def decode(planes: list[bytes], zeros: list[int], n: int) -> np.ndarray:
    """The ids, from the lowest plane up: each plane puts the numbers found so far back in the order it had."""
    out = np.zeros(n, np.uint32)
    for level, (plane, low) in enumerate(zip(reversed(planes), reversed(list(zeros)))):
        ones = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little").view(bool)
        back = np.empty(n, np.uint32)
        back[np.flatnonzero(~ones)] = out[:low]
        back[np.flatnonzero(ones)] = out[low:] | np.uint32(1 << level)
        out = back
    return out


class Shard:
    """Random access, counting and search in one shard, without decoding it."""

    def __init__(self, n_ids: int, bits: int, planes: list[bytes], ranks: list[bytes], zeros: list[int]):
        self.n, self.bits, self.zeros = n_ids, bits, list(zeros)
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    def _ones(self, level: int, place: int) -> int:
        """Ones of a plane before a place."""
        block = place // BLOCK_BITS
        first, last = block * BLOCK_BITS // 8, place // 8
        n = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][first:last]).sum())
        return n + (int(self.planes[level][last] & ((1 << place % 8) - 1)).bit_count() if place % 8 else 0)

    def _bit(self, level: int, place: int) -> int:
        return int(self.planes[level][place // 8]) >> place % 8 & 1

    def access(self, place: int) -> int:
        """The id at a place."""
        token = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, place), self._ones(level, place)
            token = token << 1 | bit
            place = self.zeros[level] + ones if bit else place - ones
        return token

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        first, last = 0, upto
        for level in range(self.bits):
            a, b = self._ones(level, first), self._ones(level, last)
            first, last = (self.zeros[level] + a, self.zeros[level] + b) if token >> self.bits - 1 - level & 1 else (first - a, last - b)
        return first, last

    def rank(self, token: int, upto: int | None = None) -> int:
        """How often an id stands before a place (in the whole shard without one)."""
        if not 0 <= token < 1 << self.bits:
            return 0
        first, last = self._range(token, self.n if upto is None else upto)
        return last - first

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence of an id, counted from 0; -1 if there is none."""
        if not 0 <= k < self.rank(token):
            return -1
        place = self._range(token, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> self.bits - 1 - level & 1
            place = self._find(level, place - self.zeros[level] if one else place, one)
        return place

    def _find(self, level: int, k: int, one: int) -> int:
        """The place of the k-th one or zero of a plane."""
        ones = self.ranks[level].astype(np.int64)
        before = ones if one else np.arange(len(ones)) * BLOCK_BITS - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        first = block * BLOCK_BITS // 8
        bits = np.unpackbits(self.planes[level][first:first + BLOCK_BITS // 8], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def occurrences(self, token: int) -> list[int]:
        """All places of an id."""
        return [self.select(token, k) for k in range(self.rank(token))]


def write_shards(docs: DataFrame, path: str, tokenizer: str, order: str = "doc_id", end_id: int = END_ID,
                 shard_ids: int = SHARD_IDS) -> None:
    """The documents' ids, each with `end_id` behind it, as shards under `path`, in ascending order of column `order`.

    NULL and empty texts have the end id alone. A NULL doc_id sorts first. Rows that repeat an id are all written, by
    their text's hash among each other. An empty table leaves no shards. Of other columns only `order` is used.
    """
    columns = dict.fromkeys([order, "doc_id", "text"])
    sorted_docs = (docs.select(*[F.col(c) for c in columns], F.xxhash64("text").alias("__tie__"))
                   .repartitionByRange(F.col(order).asc_nulls_first(), "__tie__")
                   .sortWithinPartitions(F.col(order).asc_nulls_first(), "__tie__")
                   .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, size = [], [], 0
        width = max(encode.largest.bit_length(), end_id.bit_length())
        for batch in batches:
            ids, row = batch.column(0).to_pylist(), 0
            for data, offsets in slices(batch.column(1), RUN_BYTES):
                tokens, counts = encode.encode_run(data, offsets)
                tokens = np.insert(tokens, np.cumsum(counts), np.uint32(end_id))
                for text in np.split(tokens, np.cumsum(counts + 1)[:-1]):
                    doc_ids.append(ids[row])
                    held.append(text)
                    size += len(text)
                    row += 1
                    if size >= shard_ids:
                        yield _row(part, seq, before, doc_ids, held, width)
                        doc_ids, held, size, seq, before = [], [], 0, seq + 1, before + size
        if held:
            yield _row(part, seq, before, doc_ids, held, width)
    sorted_docs.mapInArrow(pack, SHARDS).write.option("compression", "zstd").parquet(path)


def _row(part: int, seq: int, before: int, doc_ids: list, held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    ids = np.concatenate(held)
    planes, ranks, zeros = build(ids, bits)
    binary = pa.list_(pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
         pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(h) for h in held]], pa.list_(pa.int64())),
         pa.array([bits], pa.int32()), pa.array([planes], binary), pa.array([ranks], binary),
         pa.array([zeros], pa.list_(pa.int64()))],
        names=["part", "seq", "n_before", "n_ids", "doc_ids", "lengths", "bits", "planes", "ranks", "zeros"])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with `start`, the number of ids in all shards before each.

    A shard knows how many ids its own task wrote before it; the sums of whole tasks, one number each, are added up
    on the driver.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    total, starts = 0, []
    for part, n in sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect()):
        starts.append((part, total))
        total += n
    before = spark.createDataFrame(starts, "part int, part_start bigint")
    return (shards.join(F.broadcast(before), "part")  # a row for each task that wrote
            .withColumn("start", F.col("part_start") + F.col("n_before")).drop("part_start"))


def documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, unsigned 32-bit little-endian) of every document in shards."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in ("start", "n_ids", "doc_ids", "lengths", "planes", "zeros")}
                ids = decode([p.as_buffer() for p in row["planes"]], row["zeros"].as_py(), row["n_ids"].as_py())
                raw = ids.astype("<u4").tobytes()
                lengths = np.array(row["lengths"].as_py(), np.int64)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(row["start"].as_py() + ends - lengths), pa.array(lengths),
                     pa.array([raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
    return (shards.select("start", "n_ids", "doc_ids", "lengths", "planes", "zeros")
            .mapInArrow(unpack, "doc_id bigint, start bigint, n_tokens bigint, ids binary"))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """place (over all shards) of every occurrence of an id."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(r["n_ids"], r["bits"], r["planes"], r["ranks"], r["zeros"])
                yield pa.RecordBatch.from_arrays([pa.array([r["start"] + p for p in shard.occurrences(token)], pa.int64())], names=["place"])
    return shards.select("start", "n_ids", "bits", "planes", "ranks", "zeros").mapInArrow(search, "place bigint")
