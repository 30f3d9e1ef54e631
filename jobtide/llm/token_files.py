"""Token ids in binary segments with Elias-Fano encoded document boundaries.

Documents go to ranges of doc_id and are encoded in ascending order, so the
ids of all of them are one long array, cut into segments of whole documents.
A segment is one row of a Parquet table, which Spark writes, commits and
retries on any storage: its ids as little-endian unsigned integers of
`id_bytes` bytes, its doc_ids, and the boundaries of its documents, the
monotone offsets 0 .. n_ids, as an Elias-Fano code. The low bits of each offset
are packed; the high bits are a unary bit string with the place of every
RATE-th one, by which `select` finds one offset without a table of them all.
A second small table holds, per range, the ids before it.

The tokenizer that is used drops white space and case, so texts are encoded word
by word: a batch's words are coded by a dictionary, and a worker remembers the
ids of the words it has met, up to a fixed number.

Defined results: null and empty texts have the end id alone. Null doc_ids come
last; equal doc_ids are ordered by a hash of the text, and rows equal in both
are interchangeable. An empty table gives no segments. Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of

END = 1                  # id appended to each document
SEGMENT_IDS = 1 << 18    # ids after which a segment ends with the document
ROW_GROUP = 16 << 20     # bytes of a Parquet row group, the unit of a parallel read
RATE = 64                # ones between two recorded places
REMEMBERED = 1_000_000   # words whose ids a worker remembers, beside those of one group
TOGETHER = 20_000        # new words encoded as one text
GROUP_BYTES = 8 << 20    # texts whose words are looked up together
PUNCTUATION = ".,;:!?"
DOTTED_I = "\u0130"    # its lower case is a letter and a mark

SEGMENT = ("part int, segment int, before long, n_docs int, n_ids long, id_bytes int, doc_ids array<long>, "
           "ids binary, low_width int, low binary, high binary, places binary")


class EliasFano:
    """Non-decreasing offsets in about 2 + log2(last / count) bits each."""

    def __init__(self, count: int, width: int, low: bytes, high: bytes, places: bytes):
        self.count, self.width, self.low, self.high, self.places = count, width, low, high, places

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        count, last = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (last // max(1, count)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)[None, :]) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
        unary = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        unary[ones] = 1
        return cls(count, width, low, np.packbits(unary, bitorder="little").tobytes(),
                   ones[::RATE].astype("<u4").tobytes())

    def _low(self, first: int, last: int) -> np.ndarray:
        start, end = first * self.width, last * self.width
        raw = np.frombuffer(self.low, np.uint8)[start // 8:-(-end // 8)]
        bits = np.unpackbits(raw, bitorder="little")[start % 8:start % 8 + end - start]
        weights = np.int64(1) << np.arange(self.width, dtype=np.int64)
        return bits.reshape(last - first, self.width).astype(np.int64) @ weights

    def select(self, k: int) -> int:
        """The k-th offset, read from the recorded place before it on."""
        if not 0 <= k < self.count:
            raise IndexError(k)
        place = int(np.frombuffer(self.places, "<u4")[k // RATE])
        left, at = k % RATE, place // 8
        bits = np.frombuffer(self.high, np.uint8)
        skip = place % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(bits[at:at + RATE], bitorder="little"))
            ones = ones[ones >= skip]
            if left < len(ones):
                high = at * 8 + int(ones[left]) - k
                return high << self.width | int(self._low(k, k + 1)[0])
            left, at, skip = left - len(ones), at + RATE, 0

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        return (ones[:self.count] - np.arange(self.count) << self.width) + self._low(0, self.count)


class WordIds:
    """The ids of words, remembered for up to a fixed number of words.

    Known words are an Arrow array, their ids one flat array with a place and a
    length per word. A word of plain letters is one piece for the tokenizer's
    splitter, and so is the punctuation after it. New words are therefore split
    there, and their letter parts are encoded as one text, whose ids are cut after
    each id that ends a piece; all else is encoded word by word, also if the cuts
    do not add up.
    """

    def __init__(self, tokenizer_path: str, kind: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.kind = Tokenizer.from_file(tokenizer_path), kind
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.ends[k] = bool(suffix) and token.endswith(suffix)
        self.words = pa.array([], pa.string())
        self.starts = self.lengths = np.empty(0, np.int64)
        self.flat = np.empty(0, kind)

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes()
                for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words that are plain letters only."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            return self._one_by_one(words)
        raw, width = ids.tobytes(), ids.itemsize
        cuts = [0, *(cuts * width).tolist()]
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each of these distinct words, by the tokenizer."""
        letters, others, ends = {}, {}, {}
        for w in words:
            core = w.rstrip(PUNCTUATION)
            if not plain_letters(core):
                others[w] = b""
            else:
                letters[core] = b""
                if len(core) < len(w):
                    ends[w[len(core):]] = b""
        others.update(ends)
        for found, encode in ((letters, self._letters), (others, self._one_by_one)):
            wanted = list(found)
            for at in range(0, len(wanted), TOGETHER):
                found.update(zip(wanted[at:at + TOGETHER], encode(wanted[at:at + TOGETHER])))
        out = []
        for w in words:
            ids = letters.get(w) or others.get(w)
            if ids is None:
                core = w.rstrip(PUNCTUATION)
                ids = letters[core] + others[w[len(core):]]
            out.append(ids)
        return out

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of these distinct words is among the known ones; new words become known."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        if len(self.words) + len(new) > REMEMBERED:  # only words that are in use stay
            used = at.drop_null()
            self.words = self.words.take(used)
            self.starts, self.lengths = self.starts[used.to_numpy()], self.lengths[used.to_numpy()]
            self.flat, self.starts = gathered(self.flat, self.starts, self.lengths)
            at = pc.index_in(words, value_set=self.words)
        ids = self.encoded(new.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.flat.itemsize
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(ids), self.kind)))
        out = at.fill_null(0).to_numpy().astype(np.int64)
        out[at.is_null().to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        return out

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by END, and where each text's ids end.

        Arrow splits the texts at ASCII white space, which always parts words, and
        codes the words by a dictionary, so each distinct word is looked up once.
        """
        # Only the case of the special tokens' names matters to the tokenizer.
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(words.flatten())
        at = np.append(self.places(coded.dictionary), len(self.words))
        starts, lengths = np.append(self.starts, len(self.flat)), np.append(self.lengths, 1)
        cuts = np.asarray(words.offsets).astype(np.int64)
        cuts = cuts[1:] - cuts[0]
        uses = at[np.insert(coded.indices.to_numpy(), cuts, len(at) - 1)]  # END after each text's words
        ids, begins = gathered(np.append(self.flat, np.array([END], self.kind)), starts[uses], lengths[uses])
        return ids, np.append(begins, len(ids))[cuts + np.arange(1, len(cuts) + 1)]


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of `flat` one after the other, and where each begins."""
    begins = np.cumsum(lengths) - lengths
    shift = np.repeat(starts - begins, lengths)
    return flat[np.arange(len(shift)) + shift], begins


def plain_letters(word: str) -> bool:
    """Latin letters that stay single letters in lower case, before U+0250: one piece for the
    splitter in any version of the character tables."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and DOTTED_I not in word))


_KNOWN: dict[tuple[str, str], WordIds] = {}


def known_words(tokenizer_path: str, kind: str) -> WordIds:
    """This worker process's memory of words, kept from task to task."""
    if (tokenizer_path, kind) not in _KNOWN:
        _KNOWN[tokenizer_path, kind] = WordIds(tokenizer_path, kind)
    return _KNOWN[tokenizer_path, kind]


def groups(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about GROUP_BYTES, each of whole texts."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + GROUP_BYTES)))
        yield texts.slice(at, end - at)
        at = end


def id_bytes(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Encode every whole text and write segments and range starts under `path`."""
    width = id_bytes(tokenizer_path)
    kind = f"<u{width}"

    def run(batches):
        known, part, segment, before = known_words(tokenizer_path, kind), None, 0, 0
        doc_ids, pieces, lengths = [], [], [0]

        def closed():
            offsets = np.cumsum(np.array(lengths, np.int64))
            code = EliasFano.encode(offsets)
            values = [part, segment, before, len(doc_ids), int(offsets[-1]), width, doc_ids, b"".join(pieces),
                      code.width, code.low, code.high, code.places]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()),
                 pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in SEGMENT.split(", ")]
        total = 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
            rows = iter(batch.column(1).to_pylist())
            for texts in groups(batch.column(2)):
                ids, ends = known.documents(texts)
                raw, at = memoryview(ids.tobytes()), 0
                for end in ends.tolist():
                    doc_ids.append(next(rows))
                    pieces.append(raw[at * width:end * width])
                    lengths.append(end - at)
                    total, at = total + end - at, end
                    if total >= SEGMENT_IDS:
                        yield closed()
                        segment, before, total = segment + 1, before + total, 0
                        doc_ids, pieces, lengths = [], [], [0]
        if doc_ids:
            yield closed()

    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
        .withColumn("tie", F.xxhash64("text"))
    sorted_rows = rows.repartitionByRange(ranges, *order, F.monotonically_increasing_id()) \
        .sortWithinPartitions(*order)
    segments = sorted_rows.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, SEGMENT)
    segments.write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/segments")
    spark = docs.sparkSession
    sums = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sums.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("part_start")) \
        .write.parquet(f"{path}/ranges")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files alone.

    `start` is the place in the array of all ids. The range starts are
    broadcast: one row per range, as many as there are shuffle partitions.
    """
    def run(batches):
        for batch in batches:
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                get = {name: c[r].as_py() for name, c in columns.items()}
                code = EliasFano(get["n_docs"] + 1, get["low_width"], get["low"], get["high"], get["places"])
                offsets = code.all()
                ids = np.frombuffer(get["ids"], f"<u{get['id_bytes']}").astype("<u4").tobytes()
                sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(get["doc_ids"], pa.int64()),
                     pa.array(offsets[:-1] + get["part_start"] + get["before"], pa.int64()),
                     pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    segments = spark.read.parquet(f"{path}/segments")
    ranges = spark.read.parquet(f"{path}/ranges")
    return segments.join(F.broadcast(ranges), "part").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
