"""Tokens of two vocabularies aligned, with counts of linked pairs in perfectly hashed vectors.

One pass aligns all documents and finds the distinct pairs of linked ids. A minimal perfect hash
gives each pair a place without gaps; counts are then dense vectors indexed by it, summed in a tree,
and the keys that stand at the places tell a pair from any other. A second pass aligns the documents
again and looks the counts up. Pairs are dealt to shards of bounded size, each with a hash of its own.

Neither vocabulary has a token that spans the space between two words, so a text is aligned word by
word, and a word that is known is not tokenized again.
"""

from __future__ import annotations

import hashlib
import io
import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import byte_slices, map_arrow, mix64, quoted
from tablesync.llm.packing import byte_pieces, strung_encoder
from tablesync.sinks.files import stage

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs in a shard, about; vectors summed into one at once; rows added up to a vector, about.
SHARD, FAN_IN, VECTOR_ROWS = 1 << 16, 8, 4_000_000
#: Pairs whose counts are sent to all tasks (16 bytes each); more of them are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000
#: Bytes of alignments that a worker remembers, and bytes of text that it works on at once.
REMEMBERED, SLICE = 160_000_000, 1_000_000
#: Bits of a pair's code that hold the second id.
_LOW = 32
_STEP = 0x9E3779B97F4A7C15

#: The space between two words: neither vocabulary's tokens reach across it.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_RARE_SPACE = re.compile(r"[^\S \n]")


def words(text: str) -> Iterator[list[str]]:
    """The text cut at the spaces between words, in lists of bounded total length."""
    start = 0
    while start < len(text):
        cut = _BETWEEN.search(text, start + SLICE) if len(text) - start > SLICE else None
        part = text[start : cut.start()] if cut else text[start:]
        start = cut.end() if cut else len(text)
        plain = not ("  " in part or "\n " in part or " \n" in part or part[0] == " " or part[-1] == " " or _RARE_SPACE.search(part))
        yield part.split(" ") if plain else _BETWEEN.split(part)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


class Aligner:
    """Alignments of words, each found once.

    Row w of `table` holds how many tokens of A and of B word w has, how many groups, whether it is spelled
    differently by either, and with counts at hand their facts; `groups[w]` is the text of its groups.
    """

    A, B, GROUPS, WRONG, BEST, SUM = range(6)

    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self._bytes = Tokenizer.from_file(byte_vocabulary)
        self._bytes.encode_special_tokens = True
        self._strung = strung_encoder(self._bytes)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary)
        spelled = byte_pieces(self._bytes.get_vocab())
        self._a = [b""] * (max(spelled.values()) + 1)
        for piece, number in spelled.items():
            self._a[number] = piece
        names = map(self._pieces.id_to_piece, range(self._pieces.get_piece_size()))
        self._b = [
            bytes([int(name[3:5], 16)]) if self._pieces.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self._a_size, self._b_size = (np.array([len(p) for p in side], np.int64) for side in (self._a, self._b))
        # a token inside a group is followed by a comma, the last of A by a bar, the last of B by a semicolon
        self._text = [f"{i}{end}".encode() for side, last in ((self._a, "|"), (self._b, ";")) for i in range(len(side)) for end in (",", last)]
        self._text_size = np.array([len(s) for s in self._text], np.int64)
        self._apart = self._strung is not None and not any(b" " in p.lstrip(b" ") for p in self._b)
        self.counts: PairCounts | None = None
        self._used = ""
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.table = np.zeros((1024, 6), np.int64)
        self._codes, self._owners, self.size = [], [], 0

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all linked pairs, and the words they are from, which ascend."""
        if len(self._codes) != 1:
            none = np.zeros(0, np.int64)
            self._codes, self._owners = [np.concatenate([none, *self._codes])], [np.concatenate([none, *self._owners])]
        return self._codes[0], self._owners[0]

    def _encode_a(self, spaced: list[str]) -> np.ndarray:
        """Ids of all words, one after another; words without white space at their ends are strung together."""
        if self._strung is None:
            return _flat([self._bytes.encode(s, add_special_tokens=False).ids for s in spaced])
        runs, run = [], []
        for text in spaced:
            if text[1:2].isspace() or text[-1].isspace():
                runs += [self._strung.encode_ordinary("".join(run)), self._bytes.encode(text, add_special_tokens=False).ids]
                run = []
            else:
                run.append(text)
        return _flat([*runs, self._strung.encode_ordinary("".join(run))])

    def learn(self, new: list[str]) -> None:
        if not new:
            return
        pieces = self._pieces.encode(new, num_threads=1)
        spaced = [" " + word for word in new]
        whole = [s.encode() for s in spaced]
        spelled = self._b.__getitem__
        if b"".join(map(spelled, chain.from_iterable(pieces))) != b"".join(whole):
            right = [b"".join(map(spelled, ids)) == text for ids, text in zip(pieces, whole, strict=True)]
            for word in (w for w, ok in zip(new, right, strict=True) if not ok):
                self._add([word], np.array([[0, 0, 0, 1]]), [b""], 0)
            new, pieces, spaced, whole = ([x for x, ok in zip(xs, right, strict=True) if ok] for xs in (new, pieces, spaced, whole))
            if not new:
                return
        a, b = self._encode_a(spaced), _flat(pieces)
        ends = np.cumsum([len(text) for text in whole])
        a_end, b_end = np.cumsum(self._a_size[a]), np.cumsum(self._b_size[b])
        at = np.searchsorted(b_end, a_end)
        closes = b_end[at] == a_end
        closed = np.zeros(len(b), bool)
        closed[at[closes]] = True
        a_word, b_word = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        link_word = a_word[closes]
        tallies = [np.bincount(w, minlength=len(new)) for w in (a_word, b_word, link_word)]
        group = np.concatenate([2 * (np.cumsum(closes) - closes), 2 * (np.cumsum(closed) - closed) + 1])
        shown = np.concatenate([2 * a + closes, 2 * (len(self._a) + b) + closed])[np.argsort(group, kind="stable")]
        joined = b"".join(map(self._text.__getitem__, shown.tolist()))
        stops = np.cumsum(self._text_size[shown])[np.cumsum(tallies[0] + tallies[1]) - 1].tolist()
        groups = [joined[start : stop - 1] for start, stop in zip([0, *stops[:-1]], stops, strict=True)]
        self._codes.append(a[closes] << _LOW | b[at[closes]])
        self._owners.append(link_word + len(self.groups))
        self._add(new, np.stack([*tallies, np.zeros(len(new), np.int64)], axis=1), groups, int(ends[-1]) + len(joined))

    def _add(self, new: list[str], facts: np.ndarray, groups: list[bytes], size: int) -> None:
        start = len(self.groups)
        self.known.update(zip(new, range(start, start + len(new)), strict=True))
        self.groups += groups
        while len(self.groups) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[start : len(self.groups), :4] = facts
        self.size += size + 300 * len(new)
        if self.counts is not None:
            self._count(start)

    def _count(self, start: int) -> None:
        """The facts of counts for the words from `start` on."""
        codes, owners = (self._codes[-1], self._owners[-1]) if start and self._codes else self.links()
        codes, owners = codes[owners >= start], owners[owners >= start] - start
        count, best = self.counts.of(codes)
        facts = np.zeros((len(self.groups) - start, 2), np.int64)
        np.add.at(facts, owners, np.stack([best, count], axis=1))
        self.table[start : len(self.groups), self.BEST :] = facts

    def use(self, name: str, made: Callable[[], PairCounts | None]) -> None:
        """Look words up in the counts of this name, those remembered too."""
        if name != self._used:
            self._used, self.counts = name, made()
            if self.counts is not None and self.groups:
                self._count(0)

    def read(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """For each text the numbers of its words; memory is never emptied meanwhile."""
        short = [not t or len(t) <= SLICE for t in texts]
        lists = [list(self._words(t)) if t and s else [] for t, s in zip(texts, short, strict=True)]
        self.learn(list({w for part in lists for ws in part for w in ws if w not in self.known}))
        for text, part, s in zip(texts, lists, short, strict=True):
            found = []
            for ws in part if s else self._words(text):
                if not s:
                    self.learn(list({w for w in ws if w not in self.known}))
                found.append(np.fromiter(map(self.known.__getitem__, ws), np.int32, len(ws)))
            yield np.concatenate(found) if found else np.zeros(0, np.int32)

    def _words(self, text: str) -> Iterator[list[str]]:
        return words(text) if self._apart else iter([[text]])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(vocabularies: tuple[str, str]) -> Aligner:
    """One for each Python worker, whose tasks have most words in common."""
    if vocabularies not in _ALIGNERS:
        _ALIGNERS[vocabularies] = Aligner(*vocabularies)
    return _ALIGNERS[vocabularies]


def perfect_hash(keys: np.ndarray) -> list[np.ndarray]:
    """A minimal perfect hash of distinct keys: bits of several levels.

    At each level the keys that are alone at their bit set it; all others go on to the next. A
    key's place is the number of set bits before its own.
    """
    levels, rest = [], keys.astype(np.uint64)
    while len(rest):
        at = _bit(rest, len(levels), max(64, 2 * len(rest)))
        alone = np.bincount(at, minlength=max(64, 2 * len(rest))) == 1
        levels.append(alone)
        rest = rest[~alone[at]]
    return levels


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = mix64(mix64(keys) + np.uint64((level + 1) * _STEP % 2**64))
    return (mixed % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Places of keys by the levels of `perfect_hash`."""

    def __init__(self, levels: list[np.ndarray]):
        self._levels = levels
        self._before, total = [], 0
        for level in levels:
            self._before.append(np.cumsum(level, dtype=np.int64) - level + total)
            total += int(level.sum())
        self.size = total

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; for one that was not hashed any place, or -1."""
        out = np.full(len(keys), -1, np.int64)
        rest, asked = np.arange(len(keys)), keys.astype(np.uint64)
        for number, (level, before) in enumerate(zip(self._levels, self._before, strict=True)):
            at = _bit(asked[rest], number, len(level))
            here = level[at]
            out[rest[here]] = before[at[here]]
            rest = rest[~here]
        return out


def _dump(**arrays: np.ndarray) -> bytes:
    body = io.BytesIO()
    np.savez(body, **arrays)
    return body.getvalue()


def _load(body: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(body)) as arrays:
        return {name: arrays[name] for name in arrays.files}


def _hashed(body: dict[str, np.ndarray]) -> PerfectHash:
    edges = np.r_[0, np.cumsum(body["sizes"])]
    bits = np.unpackbits(body["bits"])[: edges[-1]].astype(bool)
    return PerfectHash([bits[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])


class PairCounts:
    """Counts of all pairs by shard, and the largest count of each second id."""

    def __init__(self, shards: dict[int, tuple[bytes, bytes]], number: int, best: np.ndarray):
        self._number, self._best = number, best
        self._shards = {}
        for shard, (body, counts) in shards.items():
            loaded = _load(body)
            self._shards[shard] = (_hashed(loaded), loaded["keys"], np.frombuffer(counts, np.int64))

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's count, 0 for one whose key does not stand at its place, and whether it is its second id's largest."""
        count = np.zeros(len(codes), np.int64)
        shard = mix64(codes.astype(np.uint64)).view(np.int64) % self._number
        for number in np.unique(shard):
            if int(number) in self._shards:
                places, keys, counts = self._shards[int(number)]
                rows = np.flatnonzero(shard == number)
                at = places.places(codes[rows])
                count[rows] = np.where((at >= 0) & (keys[at] == codes[rows]), counts[at], 0)
        second = np.minimum(codes & (2**_LOW - 1), len(self._best) - 1)
        return count, (count > 0) & (count == self._best[second])


def _columns(arrays: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays.values()], list(arrays))


def linked_pairs(docs: DataFrame, vocabularies: tuple[str, str]) -> DataFrame:
    """pair, mixed (a scramble of it) and n, added up over what a task remembers at once."""

    def counted(aligner: Aligner, times: np.ndarray) -> pa.RecordBatch:
        codes, owners = aligner.links()
        pairs, where = np.unique(codes, return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, where, np.r_[times, np.zeros(len(aligner.groups), np.int64)][owners])
        pairs, n = pairs[n > 0], n[n > 0]
        return _columns({"pair": pairs, "mixed": mix64(pairs.astype(np.uint64)).view(np.int64), "n": n})

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        aligner.use("", lambda: None)
        times = np.zeros(len(aligner.groups), np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                if aligner.size > REMEMBERED:
                    yield counted(aligner, times)
                    aligner.forget()
                    times = np.zeros(0, np.int64)
                for numbers in aligner.read(part.column("text").to_pylist()):
                    if len(times) < len(aligner.groups):
                        times = np.r_[times, np.zeros(len(aligner.groups), np.int64)]
                    if not aligner.table[numbers, Aligner.WRONG].any():
                        np.add.at(times, numbers, 1)
        if len(times):
            yield counted(aligner, times)

    return map_arrow(docs.select("text"), aligned, "pair bigint, mixed bigint, n bigint")


def pair_vectors(counted: DataFrame) -> tuple[DataFrame, int, int]:
    """shard, body (keys at their places, and the hash) and counts (a dense vector by place); how many
    shards and how many distinct pairs there are.

    Rows of a shard are added up in several vectors at once, which are then summed in a tree.
    """
    spark = counted.sparkSession
    distinct = stage(counted.select("pair", "mixed").distinct(), "distinct-pairs")
    pairs, rows = distinct.count(), counted.count()
    shards = max(1, -(-pairs // SHARD))
    shard = F.pmod("mixed", F.lit(shards)).cast("bigint")

    def built(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame["pair"].to_numpy()
        levels = perfect_hash(keys)
        placed = np.empty_like(keys)
        placed[PerfectHash(levels).places(keys)] = keys
        body = _dump(keys=placed, bits=np.packbits(np.concatenate(levels)), sizes=np.array([len(level) for level in levels]))
        return pd.DataFrame([{"shard": frame["shard"].iloc[0], "body": body}])

    hashes = stage(distinct.withColumn("shard", shard).groupBy("shard").applyInPandas(built, "shard bigint, body binary"), "perfect-hashes")

    parts = FAN_IN
    while rows / shards / parts > VECTOR_ROWS:
        parts *= FAN_IN
    none, zero = F.lit(None), F.lit(0).cast("bigint")
    every = F.explode(F.sequence(zero, F.lit(parts - 1).cast("bigint"))).alias("part")
    work = hashes.select("shard", every, F.lit(0).alias("kind"), "body", zero.alias("pair"), zero.alias("n")).union(
        counted.select(shard.alias("shard"), F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("part"), F.lit(1), none.cast("binary"), "pair", "n")
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by shard and part, the hash before the pairs, to one vector for each."""
        here = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            pairs_, n = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
            heads = np.flatnonzero(kinds == 0)
            for begin, end in zip(np.r_[0, heads], np.r_[heads, len(kinds)], strict=True):
                if end > begin and kinds[begin] == 0:
                    if here is not None:
                        yield _columns({"shard": here[0], "part": here[1], "counts": [here[3].tobytes()]})
                    places = _hashed(_load(batch.column("body")[int(begin)].as_py()))
                    here = [batch.column(c)[int(begin) : int(begin) + 1].to_pylist() for c in ("shard", "part")] + [places, np.zeros(places.size, np.int64)]
                    begin += 1
                if end > begin:
                    np.add.at(here[3], here[2].places(pairs_[begin:end]), n[begin:end])
        if here is not None:
            yield _columns({"shard": here[0], "part": here[1], "counts": [here[3].tobytes()]})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v, np.int64) for v in frame["counts"]], axis=0)
        return pd.DataFrame([{"shard": frame["shard"].iloc[0], "part": frame["part"].iloc[0], "counts": total.tobytes()}])

    schema = "shard bigint, part bigint, counts binary"
    vectors = map_arrow(work.repartition("shard", "part").sortWithinPartitions("shard", "part", "kind"), summed, schema)
    while parts > 1:
        parts //= FAN_IN
        dealt = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN))
        vectors = dealt.groupBy("shard", "part").applyInPandas(added, schema)
    return stage(hashes.join(vectors.select("shard", "counts"), "shard"), "pair-counts"), shards, pairs


def _pairs_with_counts(vectors: DataFrame) -> DataFrame:
    """pair, second (its second id) and count."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, counts in zip(batch.column("body").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                keys = _load(body)["keys"]
                yield _columns({"pair": keys, "second": keys & (2**_LOW - 1), "count": np.frombuffer(counts, np.int64)})

    return map_arrow(vectors.select("body", "counts"), listed, "pair bigint, second bigint, count bigint")


_FACTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align_documents(
    docs: DataFrame,
    byte_vocabulary: str | None = None,
    piece_vocabulary: str | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """The columns of `docs` but `text`, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A is the byte-level vocabulary over a space and the text, B the piece vocabulary over the text, to
    which it adds the space; both without special tokens. Where tokens of both end together, a group ends
    and the two are linked. A pair's count is the number of its links in all documents; n_best are a
    document's links whose count is the largest of their B id, ties included, count_sum is the sum over all.

    A text that is null or empty, or that either vocabulary spells otherwise, has no tokens: zeros and an
    empty groups_sha256. Columns of the added names are replaced; repeated rows count each; an empty table
    gives an empty table. Long texts are aligned piece by piece, but a run of text without a single space between
    two words as one.
    """
    names = [byte_vocabulary or public_tokenizers.path(BYTE_VOCABULARY), piece_vocabulary or public_tokenizers.path(PIECE_VOCABULARY)]
    vocabularies = (str(names[0]), str(names[1]))
    spark = docs.sparkSession
    added = [*_FACTS, "groups_sha256", "_row", "_pairs"]
    columns = [c for c in docs.columns if c != "text" and c not in added]
    counted = stage(linked_pairs(docs, vocabularies), "counted-pairs")
    vectors, shards, pairs = pair_vectors(counted)
    known = _pairs_with_counts(vectors)
    # no more rows than the vocabulary has ids
    largest = known.groupBy("second").agg(F.max("count").alias("best")).collect()
    best = np.full(max((r["second"] for r in largest), default=0) + 1, -1, np.int64)
    for row in largest:
        best[row["second"]] = row["best"]
    few = pairs <= broadcast_pairs
    bodies = {r["shard"]: (bytes(r["body"]), bytes(r["counts"])) for r in vectors.collect()} if few else {}
    name, sent = uuid.uuid4().hex, spark.sparkContext.broadcast((bodies, shards, best))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        aligner.use(name, lambda: PairCounts(*sent.value))
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                if aligner.size > REMEMBERED:
                    aligner.forget()
                facts, digests, links = [], [], []
                for numbers in aligner.read(part.column("text").to_pylist()):
                    table = aligner.table[numbers]
                    if not len(numbers) or table[:, Aligner.WRONG].any():
                        facts.append(np.zeros(6, np.int64))
                        digests.append("")
                        links.append([])
                        continue
                    sums = table.sum(axis=0)
                    facts.append(sums[[Aligner.A, Aligner.B, Aligner.GROUPS, Aligner.GROUPS, Aligner.BEST, Aligner.SUM]])
                    digests.append(_groups_digest(aligner, numbers))
                    links.append([] if few else _links(aligner, numbers))
                matrix = np.array(facts, np.int64).reshape(-1, 6)
                columns_ = [pa.array(matrix[:, i].copy()) for i in range(6)]
                lists = pa.array(links, pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())])))
                others = [part.column(c) for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*others, *columns_, pa.array(digests, pa.string()), lists],
                    [*(c for c in part.schema.names if c != "text"), *_FACTS, "groups_sha256", "_pairs"],
                )

    kinds = [f"`{c.replace('`', '``')}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    kinds += [f"{c} bigint" for c in _FACTS]
    schema = ", ".join([*kinds, "groups_sha256 string", "_pairs array<struct<pair:bigint,n:bigint>>"])
    result = map_arrow(docs.select(*quoted(columns), "text"), told, schema)
    if few:
        return result.drop("_pairs")
    result = stage(result.withColumn("_row", F.monotonically_increasing_id()), "aligned-documents")
    seconds = stage(known, "pairs-with-counts").withColumn("top", F.max("count").over(Window.partitionBy("second")))
    asked = result.select("_row", F.explode("_pairs").alias("p")).select("_row", "p.pair", "p.n")
    summed = asked.join(seconds, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("count") == F.col("top"), F.col("n"))).alias("_best"), F.sum(F.col("count") * F.col("n")).alias("_sum")
    )
    return result.drop("_pairs", "n_best", "count_sum").join(summed, "_row", "left").select(
        *quoted(columns), "n_a", "n_b", "n_groups", "n_links", F.coalesce("_best", F.lit(0)).alias("n_best"),
        F.coalesce("_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def _groups_digest(aligner: Aligner, numbers: np.ndarray) -> str:
    digest = hashlib.sha256()
    for at in range(0, len(numbers), 100_000):
        digest.update((b";" if at else b"") + b";".join(map(aligner.groups.__getitem__, numbers[at : at + 100_000].tolist())))
    return digest.hexdigest()


def _links(aligner: Aligner, numbers: np.ndarray) -> list[dict[str, int]]:
    """A document's distinct linked pairs and how often it has them."""
    which, times = np.unique(numbers, return_counts=True)
    codes, owners = aligner.links()
    begin, end = np.searchsorted(owners, which), np.searchsorted(owners, which, side="right")
    spans = [codes[x:y] for x, y in zip(begin, end, strict=True)]
    pairs, where = np.unique(np.concatenate(spans), return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, where, np.repeat(times, end - begin))
    return [{"pair": p, "n": k} for p, k in zip(pairs.tolist(), n.tolist(), strict=True)]
