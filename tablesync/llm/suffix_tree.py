"""Language-model scores from a probabilistic suffix tree.

The model predicts a text byte by byte (A-Z lower-cased, words joined by one space, an end
symbol after the last). Its states are contexts of variable length: a context becomes a state
if it is frequent and its next-symbol distribution diverges from that of its one byte shorter
suffix by more than its free parameters cost. The longest state that is a suffix of the past
predicts the next symbol; its counts are smoothed with the prediction of the next shorter
state, down to uniform bytes, so the probabilities of all texts add up to one.

All training documents are counted, and every context that is seen LEAST times with a next symbol
may become a state: their number grows with the corpus, so states and distributions are never
in one place. Grams are dealt out by the KEY bytes before the symbol. Whatever a longer context
is compared with then lies in the same part, but for the contexts below KEY bytes, which every
part knows. The result is a table of all grams that occur, with their probabilities. Scoring
takes the frequent ones from memory and joins the others; so it is with words.

Grams are sorted from the nearest byte to the farthest, so neighbours differ in their last bytes
and those of a part lie together. They cross the cluster as compressed runs, one for each part that
a task has grams of: an eight-byte gram and its counts take less than two bytes there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tablesync.llm.common import WHITE_SPACE, Words, byte_slices, map_arrow
from tablesync.sinks.files import stage

#: Bytes of the longest context.
DEPTH = 7
#: Least count of a context with its next symbol, whatever the size of the corpus.
LEAST = 2
#: Bytes before a symbol by which grams are dealt out; shorter contexts are sent to all tasks.
KEY = 3
#: Grams with at least this share of all symbols are known to every task: at most 1 / LEAST_GRAM.
#: The others are joined.
LEAST_GRAM = 5e-8
#: Words with at least this share of all tokens are known to every task: at most 1 / LEAST_WORD.
LEAST_WORD = 5e-7

#: Weight of the shorter state's prediction, in symbols for each different symbol seen.
SMOOTHING = 4
#: A context is a state if its gain in log-likelihood exceeds this, times its next symbols,
#: times the logarithm of its count (a half is the Bayesian information criterion).
DIVERGENCE = 0.5

#: Bytes of text that are counted or scored at once.
SLICE = 2_000_000
#: Grams that a task merges before it hands them on.
HELD = 5_000_000
#: Grams merged at once, about.
PIECE = 250_000
#: Symbols of a part of all grams, about, and how many parts there are at most.
PART_SYMBOLS, PARTS = 1_000_000, 2_048
#: Sums of up to 2 to this power texts are brought together at once.
BLOCK_BITS = 18

_END, _PAD = 0x09, 0x0A  # white space, so in no word


class Stream:
    """The symbols of a run of texts: `code[i]` holds symbol i in its lowest byte and the DEPTH
    bytes before it above, `first[t]` is where text t begins."""

    def __init__(self, words: Words):
        counts = np.diff(words.first)
        ends = np.r_[0, np.cumsum(words.end - words.start + 1)]
        symbols = ends[words.first[1:]] - ends[words.first[:-1]] + (counts == 0)
        self.first = np.r_[0, np.cumsum(symbols)]
        # a word and the gap after it, which is one symbol; a text without words has its last gap alone
        kept = ~WHITE_SPACE[words.data]
        kept[words.end] = True
        kept[np.r_[words.text_start[1:], len(words.data)][counts == 0] - 1] = True
        stream = np.r_[np.full(7, _PAD, np.uint8), words.data[kept]]
        symbol = stream[7:]
        symbol[WHITE_SPACE[symbol]] = 0x20
        symbol[self.first[1:] - 1] = _END
        self.code = np.ndarray((len(symbol),), ">u8", stream, strides=(1,)).astype(np.uint64)
        for at in range(DEPTH):
            # what stands before a text: its end symbol, and padding
            own = self.first[:-1][symbols > at] + at
            before = int.from_bytes(bytes([_PAD] * (DEPTH - 1 - at) + [_END]) + bytes(at + 1))
            self.code[own] = self.code[own] & _mask(at + 1) | np.uint64(before)


def _mask(count: int) -> np.uint64:
    return np.uint64((1 << 8 * count) - 1)


def _word_array(words: Words) -> pa.Array:
    """The words as an Arrow array of strings."""
    lengths = words.end - words.start
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    place = np.arange(offsets[-1]) + np.repeat(words.start - offsets[:-1], lengths)
    body = np.ascontiguousarray(words.data[place])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(body))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE):
            yield _words_of(part)


def _words_of(part: pa.RecordBatch) -> pa.RecordBatch:
    words = Words(part.column("text"))
    coded = _word_array(words).dictionary_encode()
    code, distinct = coded.indices.to_numpy(), len(coded.dictionary)
    train = ~part.column("held_out").to_numpy(zero_copy_only=False)[words.owner]
    return pa.RecordBatch.from_arrays(
        [
            coded.dictionary.cast(pa.string()),
            pa.array(np.bincount(code, minlength=distinct)),
            pa.array(np.bincount(code[train], minlength=distinct)),
        ],
        ["word", "n_all", "n"],
    )


def _near_first(code: np.ndarray) -> np.ndarray:
    """Codes with the byte before the symbol highest, the farthest one below, and the symbol lowest."""
    turned = code.byteswap()
    return (turned << np.uint64(8)) | (turned >> np.uint64(56))


def _far_first(code: np.ndarray) -> np.ndarray:
    """Codes of a Stream from those of `_near_first`."""
    return ((code >> np.uint64(8)) | (code << np.uint64(56))).byteswap()


def _pack(values: np.ndarray) -> bytes:
    """64-bit values, compressed; bytes of equal weight stand together, as the high ones are mostly zero."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def _unpack(packed: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=8 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def _pack_ascending(code: np.ndarray) -> bytes:
    return _pack(np.diff(code, prepend=np.uint64(0)))


def _unpack_ascending(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpack(packed, size, np.uint64), dtype=np.uint64)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[Row]]]:
    """The rows of each part, from rows in the order of `part`."""
    rows = (Row(**row) for batch in batches for at in range(batch.num_rows) for row in batch.slice(at, 1).to_pylist())
    return groupby(rows, key=lambda row: row.part)


def _parts(code: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The parts that hold some of these ascending codes (near byte first), and where; `edges` are the first codes of all parts but one."""
    for part, (start, stop) in enumerate(pairwise([0, *np.searchsorted(code, edges).tolist(), len(code)])):
        if stop > start:
            yield part, slice(start, stop)


def _edges(code: np.ndarray, count: np.ndarray) -> np.ndarray:
    """First codes of parts with about equal numbers of symbols; `code` are grams of KEY bytes, as in a Stream.

    What follows the same KEY bytes is in one part.
    """
    key = _near_first(code << np.uint64(8)) >> np.uint64(8 * (8 - KEY))
    order = np.argsort(key)
    key, before = key[order], np.cumsum(count[order]) - count[order]
    part = before // max(PART_SYMBOLS, -(-int(count.sum()) // PARTS))
    return key[np.flatnonzero(np.diff(part)) + 1] << np.uint64(8 * (8 - KEY))


_COUNTS = "part int, size bigint, codes binary, n_all binary, n binary"


def _count_grams(edges: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of each task, in all texts and in those held in, merged as they grow."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for part in byte_slices(batch, "text", 2 * SLICE):
                yield from _counted(part)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, counts in _merged_as_they_grow(slices(batches)):
            rows = [
                (part, own.stop - own.start, _pack_ascending(code[own]), *(_pack(counts[own, c].astype(np.int64)) for c in (0, 1)))
                for part, own in _parts(code, edges)
            ]
            yield _record_batch(rows, _COUNTS)

    return count


def _counted(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    stream = Stream(Words(part.column("text")))
    train = ~part.column("held_out").to_numpy(zero_copy_only=False)
    train = np.repeat(train, np.diff(stream.first))
    code = _near_first(stream.code)
    for own, n in ((code[train], 1), (code[~train], 0)):
        distinct, count = np.unique(own, return_counts=True)
        yield distinct, np.stack([count, count * n], axis=1).astype(np.uint32)


_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, _TYPES[kind]) for column, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def _count_short_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each task for contexts below KEY bytes, in all texts and in those held in."""

    def counted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                stream = Stream(Words(part.column("text")))
                train = ~part.column("held_out").to_numpy(zero_copy_only=False)
                code, train = stream.code & _mask(KEY), np.repeat(train, np.diff(stream.first))
                for own, n in ((code[train], 1), (code[~train], 0)):
                    distinct, count = np.unique(own, return_counts=True)
                    yield distinct, np.stack([count, count * n], axis=1).astype(np.uint32)

    for code, count in _merged_as_they_grow(counted()):
        columns = code.view(np.int64), *(count[:, c].astype(np.int64) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["code", "n_all", "n"])


def _merged_as_they_grow(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes in ascending order with the sums of their counts, handed on when there are many or 32 bits might not hold a count."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows, limit, symbols = 0, HELD, 0
    for code, count in parts:
        added = int(count[:, 0].sum(dtype=np.int64))
        if held and symbols + added >= 1 << 32:
            yield _merged(held)
            held, rows, limit, symbols = [], 0, HELD, 0
        held.append((code, count))
        rows, symbols = rows + len(code), symbols + added
        if rows > limit:
            held = [_merged(held)]
            rows = len(held[0][0])
            limit = rows + HELD
        if rows > HELD and len(held) == 1:
            yield held.pop()
            rows, limit, symbols = 0, HELD, 0
    if held:
        yield _merged(held)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The same from several ascending runs, piece by piece; counts keep their type."""
    longest = max((code for code, _ in held), key=len)
    cuts = longest[PIECE // len(held) :: max(PIECE // len(held), 1)]
    ends = [[0, *np.searchsorted(code, cuts).tolist(), len(code)] for code, _ in held]
    pieces = [
        _summed(*(np.concatenate([run[c][end[k] : end[k + 1]] for run, end in zip(held, ends, strict=True)]) for c in (0, 1)))
        for k in range(len(cuts) + 1)
    ]
    return tuple(np.concatenate(column) for column in zip(*pieces, strict=True))


def _summed(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(count, first, dtype=count.dtype) if len(code) else count


Level = tuple[np.ndarray, np.ndarray, np.ndarray]


def _totals(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ascending grams with their counts, their contexts' counts and numbers of next symbols."""
    if not len(code):
        return code, n, n, n
    context = code >> np.uint64(8)
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    kinds = np.diff(np.r_[first, len(code)])
    return code, n, np.repeat(np.add.reduceat(n, first), kinds), np.repeat(kinds, kinds)


class SuffixTree:
    """States by context length, and the probabilities of their next symbols.

    `contexts[d]` (ascending) with `escape[d]`: the weight of the shorter state's prediction;
    `grams[d]` (ascending, context above symbol) with `chance[d]`.
    """

    def __init__(self) -> None:
        empty = np.zeros(0, np.uint64)
        self.contexts, self.grams = [empty] * (DEPTH + 1), [empty] * (DEPTH + 1)
        self.escape, self.chance = [np.zeros(0)] * (DEPTH + 1), [np.zeros(0)] * (DEPTH + 1)

    def add(self, depth: int, code: np.ndarray, count: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> None:
        """States of one length, shorter lengths first: next symbols with their counts, and for
        each the count of its context and the number of different symbols seen after it.

        A kept symbol has its share of the counts, interpolated with the shorter state's
        prediction, which counts as SMOOTHING symbols for each kind seen. Symbols left out share what remains as the shorter state does.
        """
        order = np.argsort(code)
        code, count, total, kinds = code[order], count[order], total[order], kinds[order]
        context = code >> np.uint64(8)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(code) else np.zeros(0, np.int64)
        shorter = self.probability(code, depth - 1)
        weight = SMOOTHING * kinds
        chance = (count + weight * shorter) / (total + weight)
        if len(code):
            rest = 1 - np.add.reduceat(chance, first), 1 - np.add.reduceat(shorter, first)
            self.escape[depth] = np.maximum(rest[0], 1e-12) / np.maximum(rest[1], 1e-12)
        self.contexts[depth], self.grams[depth], self.chance[depth] = context[first], code, chance

    def grow(self, code: np.ndarray, count: np.ndarray, depths: range, known: Level | None = None) -> Level | None:
        """Add the states of some lengths from the counts of grams that are at least as long.

        `known` is the level below the first of them, frequent grams with their counts and
        those of their contexts; the last level comes back.
        """
        for depth in depths:
            level, n = _summed(code & _mask(depth + 1), count)
            level, n, total, kinds = _totals(level, n)
            often = n >= LEAST
            level, n, total, kinds = level[often], n[often], total[often], kinds[often]
            kept = np.ones(len(level), bool)
            if known is not None and len(level):
                at = np.searchsorted(known[0], level & _mask(depth))
                gain = n * np.log(n / total * known[2][at] / known[1][at])
                context = level >> np.uint64(8)
                first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                symbols = np.diff(np.r_[first, len(level)])
                states = np.add.reduceat(gain, first) > DIVERGENCE * symbols * np.log(total[first])
                kept = np.repeat(states, symbols)
            self.add(depth, level[kept], n[kept], total[kept], kinds[kept])
            known = level, n, total
        return known

    def probability(self, code: np.ndarray, deepest: int | None = None) -> np.ndarray:
        """Of the lowest byte of each code after the bytes above it."""
        found, weight = np.full(len(code), 1 / 256), np.ones(len(code))
        left = np.arange(len(code))
        for depth in range(DEPTH if deepest is None else deepest, -1, -1):
            grams, contexts = self.grams[depth], self.contexts[depth]
            if not len(contexts) or not len(left):
                continue
            gram = code[left] & _mask(depth + 1)
            at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
            hit = grams[at] == gram
            found[left[hit]] = self.chance[depth][at[hit]]
            left, context = left[~hit], gram[~hit] >> np.uint64(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            state = contexts[at] == context
            weight[left[state]] *= self.escape[depth][at[state]]
        return found * weight


def learn(train: DataFrame) -> SuffixTree:
    """The tree of the texts in the column `text`, in one place: for corpora that fit the driver.

    `chances` has the same probabilities for corpora of any size.
    """
    docs = train.select("text", F.lit(False).alias("held_out"))
    rows = map_arrow(docs, _count_grams(np.zeros(0, np.uint64)), _COUNTS).collect()
    tree = SuffixTree()
    if rows:
        code, count = _unpacked(rows)
        tree.grow(_far_first(code), count[:, 1], range(DEPTH + 1))
    return tree


def _unpacked(rows: Iterator[Row]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of one part with their counts from all tasks."""
    return _merged([
        (_unpack_ascending(r.codes, r.size), np.stack([_unpack(packed, r.size) for packed in (r.n_all, r.n)], axis=1)) for r in rows
    ])


_CHANCES = "part int, common boolean, size bigint, codes binary, chances binary"


def chances(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Chance (log10) of all grams of `text`, learned from the texts not held out, and the edges of their parts.

    A row holds the grams of a part, near byte first, that are `common` (have the share LEAST_GRAM of all symbols) or that are not.
    """
    docs = docs.select("text", "held_out")
    short = map_arrow(docs, _count_short_grams, "code bigint, n_all bigint, n bigint")
    short = short.groupBy("code").agg(F.sum("n_all").alias("n_all"), F.sum("n").alias("n")).toArrow()
    code, n_all, n = (short.column(c).to_numpy() for c in ("code", "n_all", "n"))
    code, edges = code.view(np.uint64), _edges(code.view(np.uint64), n_all)
    least_gram = math.ceil(LEAST_GRAM * int(n_all.sum()))
    tree = SuffixTree()
    known = tree.grow(code[n > 0], n[n > 0], range(KEY))
    shared = docs.sparkSession.sparkContext.broadcast((tree, known))

    def modelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            code, count = _unpacked(rows)
            own, below = SuffixTree(), shared.value[1]
            for name, levels in vars(shared.value[0]).items():
                setattr(own, name, list(levels))
            plain, train = _far_first(code), count[:, 1] > 0
            own.grow(plain[train], count[train, 1], range(KEY, DEPTH + 1), below)
            chance, common = np.log10(own.probability(plain)), count[:, 0] >= least_gram
            rows = [
                (part, which, int(some.sum()), _pack_ascending(code[some]), _pack(chance[some]))
                for which, some in ((True, common), (False, ~common))
                if some.any()
            ]
            yield _record_batch(rows, _CHANCES)

    grams = map_arrow(docs, _count_grams(edges), _COUNTS)
    dealt = grams.repartition("part").sortWithinPartitions("part")
    return stage(map_arrow(dealt, modelled, _CHANCES), "chances"), edges


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(doc_id as text) mod 7 is 2 are held out, the others are learned from;
    a null doc_id counts as empty text there. Tokens are the words (A-Z lower-cased, cut at
    ASCII white space) and one end; a null text counts as empty and has the end alone.
    base_score is the add-one unigram log10 probability of the tokens, score the suffix tree's
    log10 probability of the text. Repeated rows are scored, and learned from, one by one. If
    nothing is held in, every symbol is uniform. An empty table gives an empty table.
    """
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    docs = docs.select("doc_id", "text", (part == 2).alias("held_out"))
    # a row's number has to be the same for its words and its grams
    docs = stage(docs.withColumn("row", F.monotonically_increasing_id()), "numbered-texts", compression="zstd")
    spark = docs.sparkSession

    counted = map_arrow(docs.select("text", "held_out"), _count_words, "word string, n_all bigint, n bigint")
    counted = stage(counted.groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n").alias("n")), "word-counts")
    ends = docs.groupBy("held_out").count().collect()
    train_ends = sum(r["count"] for r in ends if not r["held_out"])
    sums = counted.agg(F.sum("n_all").alias("n_all"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("kinds")).first()
    tokens = (sums["n"] or 0) + train_ends
    divisor = tokens + (sums["kinds"] or 0) + int(train_ends > 0) + 1
    frequent = counted.filter(F.col("n_all") >= math.ceil(LEAST_WORD * (sums["n_all"] or 0)))
    known = spark.sparkContext.broadcast(frequent.select("word", "n").toArrow().combine_chunks())
    grams, edges = chances(docs)
    common_grams = spark.sparkContext.broadcast(_common_grams(grams.filter("common").collect()))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of sums for each text, and a row for each of its words that is not frequent."""
        names = known.value.column("word")
        names = (names.combine_chunks() if names.num_chunks else pa.array([], pa.string())).cast(pa.large_string())
        counts = known.value.column("n").to_numpy()
        chance = np.log10((np.r_[counts, 0] + 1) / divisor)
        end = math.log10((train_ends + 1) / divisor)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                yield from parts_of(part, names, counts, chance, end)

    def parts_of(part, names, counts, chance, end) -> list[pa.RecordBatch]:
        words = Words(part.column("text"))
        spelled = _word_array(words)
        index = pc.fill_null(pc.index_in(spelled, value_set=names), -1).to_numpy(zero_copy_only=False)
        common = index >= 0
        base = np.bincount(words.owner[common], chance[index[common]], words.texts) + end
        seen = np.bincount(words.owner[common], np.r_[counts, 0][index[common]] > 0, words.texts)
        row, doc, held_out = (part.column(c) for c in ("row", "doc_id", "held_out"))
        own = pa.RecordBatch.from_arrays(
            [
                row, doc, held_out, pa.nulls(words.texts, pa.string()), pa.array(np.diff(words.first) + 1),
                pa.array(seen.astype(np.int64) + int(train_ends > 0)), pa.array(base),
            ],
            _SUMS,
        )
        rare = np.flatnonzero(~common)
        owner, none, zero = pa.array(words.owner[rare]), pa.array(np.zeros(len(rare), np.int64)), pa.array(np.zeros(len(rare)))
        single = pa.RecordBatch.from_arrays(
            [
                row.take(owner), pa.nulls(len(rare), doc.type), pa.nulls(len(rare), held_out.type),
                spelled.take(pa.array(rare)).cast(pa.string()), none, none, zero,
            ],
            _SUMS,
        )
        return [own, single]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of the texts' frequent grams, and each other gram with the rows of the texts it stands in, once for each time."""
        known, chance = common_grams.value
        chance = np.r_[chance, 0.0]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                stream, row = Stream(Words(part.column("text"))), part.column("row").to_numpy()
                code = _near_first(stream.code)
                order = np.argsort(code)
                code = code[order]
                owner = np.repeat(np.arange(len(row)), np.diff(stream.first))[order]
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                at = np.minimum(np.searchsorted(known, code[first]), max(len(known) - 1, 0))
                hit = known[at] == code[first] if len(known) else np.zeros(len(first), bool)
                times = np.diff(np.r_[first, len(code)])
                sums = np.bincount(owner, np.repeat(np.where(hit, chance[at], 0.0), times), len(row))
                yield _record_batch([(int(row[0] % (len(edges) + 1)), _OWN, len(row), None, _pack(sums), *_packed_rows(row))], _GRAMS)
                rare = ~np.repeat(hit, times)
                held.append((code[rare], row[owner[rare]]))
                if sum(len(rows) for _, rows in held) > HELD // 2:
                    yield _listed(held, edges)
                    held = []
        if held:
            yield _listed(held, edges)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums by row, of the parts of one task, as a run for each block of rows."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, rows in _by_part(batches):
            code, chance = np.zeros(0, np.uint64), np.zeros(0)
            for r in rows:
                if r.kind == _CHANCE:
                    code, chance = _unpack_ascending(r.codes, r.size), _unpack(r.numbers, r.size, np.float64)
                    continue
                if r.kind == _OWN:
                    logs = _unpack(r.numbers, r.size, np.float64)
                else:
                    at = np.searchsorted(code, _unpack_ascending(r.codes, r.size))
                    logs = np.repeat(chance[at], _unpack(r.numbers, r.size))
                held.append(_summed(_unpack(r.rows, len(logs)) + r.base, logs))
                if sum(len(row) for row, _ in held) > HELD // 2:
                    held = [_merged(held)]
                    if len(held[0][0]) > HELD // 4:
                        yield _blocks(*held.pop())
        if held:
            yield _blocks(*_merged(held))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, from the sums of all tasks."""
        for _, rows in _by_part(batches):
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for r in rows:
                held.append((_unpack(r.rows, r.size) + r.base, _unpack(r.numbers, r.size, np.float64)))
                if sum(len(row) for row, _ in held) > HELD // 2:
                    held = [_merged(held)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _merged(held)], ["row", "score"])

    sums_and_words = map_arrow(
        docs, scored,
        f"row bigint, doc_id {kind}, held_out boolean, word string, n_tokens bigint, n_known bigint, base double",
    )
    # a word holds no white space: a text's own row matches no word and goes to a partition by chance
    word = F.coalesce("word", F.concat(F.lit("\t"), F.col("row").cast("string")))
    rare = counted.filter(F.col("n_all") < math.ceil(LEAST_WORD * (sums["n_all"] or 0))).select(F.col("word").alias("key"), "n")
    joined = sums_and_words.withColumn("key", word).join(rare.hint("shuffle_hash"), "key", "left")
    n = F.coalesce("n", F.lit(0))
    is_word = F.col("word").isNotNull()
    joined = joined.select(
        "row", "doc_id", "held_out", "n_tokens",
        F.when(is_word, (n > 0).cast("bigint")).otherwise(F.col("n_known")).alias("n_known"),
        F.when(is_word, F.log10((n + 1) / F.lit(float(divisor)))).otherwise(F.col("base")).alias("base"),
    )
    sums_and_grams = map_arrow(docs.select("row", "text"), predicted, _GRAMS)
    rare_grams = grams.filter("not common").select(
        "part", F.lit(_CHANCE).alias("kind"), "size", "codes", F.col("chances").alias("numbers"),
        F.lit(0).cast("bigint").alias("base"), F.lit(None).cast("binary").alias("rows"),
    )
    dealt = sums_and_grams.unionByName(rare_grams).repartition("part").sortWithinPartitions("part", "kind")
    # a text has a sum from each task that holds some of its grams: no more than it has rare grams
    dealt = map_arrow(dealt, summed, _SUMMED).repartition("part").sortWithinPartitions("part")
    scores = map_arrow(dealt, totals, "row bigint, score double")
    total = joined.unionByName(scores, allowMissingColumns=True).groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.max("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    )
    return total.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def _common_grams(rows: list[Row]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending codes, near byte first, and their chances."""
    rows = sorted(rows, key=lambda r: r.part)
    codes = [_unpack_ascending(r.codes, r.size) for r in rows]
    values = [_unpack(r.chances, r.size, np.float64) for r in rows]
    return np.concatenate([np.zeros(0, np.uint64), *codes]), np.concatenate([np.zeros(0), *values])


def _packed_rows(row: np.ndarray) -> tuple[int, bytes]:
    """The least row, and the others as distances from it."""
    return int(row.min()), _pack(row - row.min())


def _blocks(row: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    """Sums of ascending rows, block by block."""
    block, first = np.unique(row >> BLOCK_BITS, return_index=True)
    runs = [slice(*ends) for ends in pairwise([*first.tolist(), len(row)])]
    packed = ((own.stop - own.start, _pack(total[own]), *_packed_rows(row[own])) for own in runs)
    return _record_batch([(part, *run) for part, run in zip(block.tolist(), packed, strict=True)], _SUMMED)


def _listed(held: list[tuple[np.ndarray, np.ndarray]], edges: np.ndarray) -> pa.RecordBatch:
    """For each part its different codes, how often they occur, and the row of each time, in the order of the codes."""
    code, row = (np.concatenate([run[c] for run in held]) for c in (0, 1))
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    listed = []
    for part, own in _parts(code, edges):
        distinct, count = np.unique(code[own], return_counts=True)
        listed.append((part, _RARE, len(distinct), _pack_ascending(distinct), _pack(count), *_packed_rows(row[own])))
    return _record_batch(listed, _GRAMS)


_SUMS = ["row", "doc_id", "held_out", "word", "n_tokens", "n_known", "base"]
_GRAMS = "part int, kind int, size bigint, codes binary, numbers binary, base bigint, rows binary"
_SUMMED = "part bigint, size bigint, numbers binary, base bigint, rows binary"
# Fixed values, in the order that scoring needs: chances of a part's grams, grams with the rows of their texts, sums of texts.
_CHANCE, _RARE, _OWN = 0, 1, 2
