"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The likelihood of
a word is the sum over all its segmentations into pieces, found by the forward algorithm; a
text is the product of its words. The probabilities come from expectation-maximisation with the
same sums. Words are scored once for each run of texts, all words of a length together; long words, and
those whose sums are too small for that, are scored one by one with logarithms.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tablesync.llm.common import Words, byte_slices, map_arrow, quoted
from tablesync.sinks.files import stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Training documents of one language, about: more are thinned by a hash of their ids.
TRAIN_DOCS = 3000
#: Words of more bytes are scored one by one.
LONG_WORD = 48
#: Sums below this are found again with logarithms.
TINY = 1e-280
ROUNDS = 3
UNKNOWN = "und"

_LETTERS = r"[^\p{L}\p{M}]+"


@dataclass
class Pieces:
    """Hashes of the vocabulary's pieces in ascending order, and their languages' probabilities."""

    keys: np.ndarray
    languages: list[str]
    longest: int
    chance: np.ndarray  # pieces x languages, and a last row of zeros
    prior: np.ndarray


def _chain(data: np.ndarray, code: np.ndarray) -> np.ndarray:
    """One step of the hash of a byte string, byte by byte."""
    with np.errstate(over="ignore"):
        code = (code ^ (data.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return code ^ (code >> np.uint64(29))


#: A piece that can stand in a word: a space at most before it, no other ASCII but small letters.
_USABLE = re.compile(rb" ?[a-z\x80-\xff]*")


def vocabulary_keys(path: str) -> tuple[np.ndarray, int]:
    """Hashes of the pieces in a file of base64 pieces that can stand in a word, and the longest one's bytes."""
    with open(path, "rb") as file:
        pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    pieces = [p for p in pieces if p and _USABLE.fullmatch(p)]
    keys = []
    for length in sorted({len(p) for p in pieces}):
        same = [p for p in pieces if len(p) == length]
        table = np.frombuffer(b"".join(same), np.uint8).reshape(len(same), length)
        code = np.zeros(len(same), np.uint64)
        for at in range(length):
            code = _chain(table[:, at], code)
        keys.append(code)
    return np.unique(np.concatenate(keys)), max(map(len, pieces))


def letters(texts: pa.Array) -> pa.Array:
    """Lower-cased words of letters and marks, one space apart, with a space before each."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return pc.replace_substring_regex(lowered, _LETTERS, " ")


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the distinct words stand (start, length), and each word's number among them."""
    _, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return words.start[first], (words.end - words.start)[first], number


def _numbers(code: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The pieces' numbers by their hashes, len(keys) for none."""
    at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
    return np.where(keys[at] == code, at, len(keys))


class Lattice:
    """The pieces inside all words of one length: `piece[t][k]` numbers the piece of k + 1 bytes
    that ends at byte t (one past the last piece: none). A word is its bytes after a space."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: int, keys: np.ndarray, longest: int):
        self.size = length + 1
        text = np.full((len(start), self.size), 32, np.uint8)
        text[:, 1:] = data[start[:, None] + np.arange(length)]
        self.piece: list[list[np.ndarray]] = [[] for _ in range(self.size)]
        for begin in range(self.size):
            code = np.zeros(len(start), np.uint64)
            for end in range(begin, min(begin + longest, self.size)):
                code = _chain(text[:, end], code)
                self.piece[end].append(_numbers(code, keys))
        for end in range(self.size):
            self.piece[end].reverse()  # appended from the longest to the shortest

    def forward(self, chance: np.ndarray) -> list[np.ndarray]:
        """Sums over all segmentations of the first t bytes; `chance` has a last row of zeros."""
        sums = [np.ones((len(self.piece[0][0]), chance.shape[1]))]
        for end in range(self.size):
            sums.append(sum(sums[end - k] * chance[piece] for k, piece in enumerate(self.piece[end])))
        return sums

    def expected(self, chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces (the last row counts none), words weighted by `weight`."""
        ahead = self.forward(chance)
        behind = [np.zeros(0)] * (self.size + 1)
        behind[self.size] = np.divide(weight, ahead[self.size], out=np.zeros_like(weight), where=ahead[self.size] > 0)
        counts = np.zeros_like(chance)
        for end in range(self.size - 1, -1, -1):
            after = behind[end + 1]
            for k, piece in enumerate(self.piece[end]):
                share = chance[piece] * after
                use = ahead[end - k] * share
                for language in range(chance.shape[1]):
                    counts[:, language] += np.bincount(piece, use[:, language], len(counts))
                at = end - k
                behind[at] = share if not len(behind[at]) else behind[at] + share
        return counts


class LongWord:
    """The same sums for one word of any length, as logarithms: `piece[t, k]` numbers the piece of k + 1
    bytes that ends at byte t."""

    def __init__(self, word: bytes, keys: np.ndarray, longest: int):
        text = np.frombuffer(b" " + word, np.uint8)
        self.size = len(text)
        self.piece = np.full((self.size, min(longest, self.size)), len(keys))
        code = np.zeros(self.size, np.uint64)
        for k in range(self.piece.shape[1]):
            code = _chain(text[k:], code[: self.size - k])
            self.piece[k:, k] = _numbers(code, keys)

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """Logarithms of the sums over all segmentations of the first t bytes."""
        sums = np.zeros((self.size + 1, logs.shape[1]))
        for end in range(self.size):
            width = min(end + 1, self.piece.shape[1])
            sums[end + 1] = np.logaddexp.reduce(sums[end - width + 1 : end + 1] + logs[self.piece[end, :width][::-1]])
        return sums

    def expected(self, logs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces, the word weighted by language."""
        ahead = self.forward(logs)
        behind = np.full_like(ahead, -np.inf)
        behind[self.size] = 0
        counts = np.zeros_like(logs)
        for end in range(self.size - 1, -1, -1):
            width = min(end + 1, self.piece.shape[1])
            pieces = self.piece[end, :width]
            share = logs[pieces] + behind[end + 1]
            begin = end - np.arange(width)
            with np.errstate(invalid="ignore"):
                behind[begin] = np.logaddexp(behind[begin], share)
                np.add.at(counts, pieces, weight * np.exp(ahead[begin] + share - ahead[self.size]))
        return counts


def _lattices(data: np.ndarray, start: np.ndarray, length: np.ndarray, pieces: Pieces):
    """Numbers of words of equal length, up to LONG_WORD, a bounded number at a time, with their lattice."""
    most = max(1000, 200_000 // max(4, len(pieces.languages)))
    for size in np.unique(length[length <= LONG_WORD]):
        same = np.flatnonzero(length == size)
        for part in range(0, len(same), most):
            chosen = same[part : part + most]
            yield chosen, Lattice(data, start[chosen], int(size), pieces.keys, pieces.longest)


def _logs(chance: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(chance)


def log_likelihoods(data: np.ndarray, start: np.ndarray, length: np.ndarray, pieces: Pieces) -> np.ndarray:
    """For each word the logarithm of its likelihood in each language."""
    logs = np.zeros((len(start), len(pieces.languages)))
    alone = length > LONG_WORD
    for chosen, lattice in _lattices(data, start, length, pieces):
        total = lattice.forward(pieces.chance)[-1]
        tiny = (total < TINY).any(axis=1)
        alone[chosen[tiny]] = True
        logs[chosen] = np.log(np.maximum(total, TINY))
    table = _logs(pieces.chance) if alone.any() else None
    for word in np.flatnonzero(alone):
        spelled = data[start[word] : start[word] + length[word]].tobytes()
        logs[word] = LongWord(spelled, pieces.keys, pieces.longest).forward(table)[-1]
    return logs


def expected_counts(data: np.ndarray, start: np.ndarray, length: np.ndarray, weight: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected counts of the pieces in words weighted by language."""
    counts = np.zeros_like(pieces.chance)
    alone = length > LONG_WORD
    for chosen, lattice in _lattices(data, start, length, pieces):
        tiny = ((lattice.forward(pieces.chance)[-1] < TINY) & (weight[chosen] > 0)).any(axis=1) if lattice.size > 16 else np.zeros(len(chosen), bool)
        alone[chosen[tiny]] = True
        counts += lattice.expected(pieces.chance, np.where(tiny[:, None], 0, weight[chosen]))
    table = _logs(pieces.chance) if alone.any() else None
    for word in np.flatnonzero(alone):
        spelled = data[start[word] : start[word] + length[word]].tobytes()
        counts += LongWord(spelled, pieces.keys, pieces.longest).expected(table, weight[word])
    return counts


def learn(train: DataFrame, vocabulary: str) -> Pieces:
    """Piece probabilities from the columns text and lang (not null), by distributed EM.

    Of each language about TRAIN_DOCS documents are used, chosen by a hash of their ids; the
    rest would not change a table of this size. The driver holds one number for each piece and
    language.
    """
    keys, longest = vocabulary_keys(vocabulary)
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    prior = np.array([sizes[x] for x in languages], np.float64)
    model = Pieces(keys, languages, longest, np.zeros((len(keys) + 1, len(languages))), np.log(prior / max(prior.sum(), 1)))
    if not languages:
        return model
    shares = [(x, TRAIN_DOCS / sizes[x]) for x in languages if sizes[x] > TRAIN_DOCS]
    taken = F.lit(True)
    for language, share in shares:
        lucky = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000)
        taken = F.when(F.col("lang") == language, lucky).otherwise(taken)
    index = {x: i for i, x in enumerate(languages)}

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                lang = np.array([index[x] for x in part.column("lang").to_pylist()])
                words = Words(letters(part.column("text")))
                start, length, number = _distinct(words)
                owner = words.owner
                pair, count = np.unique(number * len(index) + lang[owner], return_counts=True)
                word = pair // len(index)
                spelling = [bytes(words.data[s : s + n]) for s, n in zip(start[word], length[word], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spelling, pa.binary()), pa.array(pair % len(index)), pa.array(count)], ["word", "language", "n"]
                )

    words = map_arrow(train.filter(taken).select("text", "lang"), spelled, "word binary, language bigint, n bigint")
    words = stage(words.groupBy("word", "language").agg(F.sum("n").alias("n")), "training-words")

    chance = np.full((len(keys) + 1, len(languages)), 1.0 / len(keys))
    chance[-1] = 0
    for _ in range(ROUNDS):
        shared = train.sparkSession.sparkContext.broadcast(replace(model, chance=chance))

        def expected(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            total = np.zeros_like(known.chance)
            for batch in batches:
                body = batch.column("word")
                spelling = body.to_pylist()
                length = np.array([len(w) for w in spelling])
                data = np.frombuffer(b"".join(spelling), np.uint8)
                start = np.cumsum(length) - length
                weight = np.zeros((len(spelling), len(known.languages)))
                weight[np.arange(len(spelling)), batch.column("language").to_numpy()] = batch.column("n").to_numpy()
                total += expected_counts(data, start, length, weight, known)
            piece, language = np.nonzero(total[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(language), pa.array(total[piece, language])], ["piece", "language", "count"]
            )

        counts = map_arrow(words, expected, "piece bigint, language bigint, count double")
        counts = counts.groupBy("piece", "language").agg(F.sum("count").alias("count")).toArrow()
        table = np.zeros_like(chance)
        table[counts.column("piece").to_numpy(), counts.column("language").to_numpy()] = counts.column("count").to_numpy()
        table[:-1] += 0.01
        chance = table / table.sum(axis=0)
    model.chance = chance
    return model


def identify(docs: DataFrame, model: Pieces) -> DataFrame:
    """All columns of `docs` with lang_pred and score (replacing columns of these names).

    score is the language's posterior, the log-likelihoods being divided by the square root of
    the number of words, because the words of a text are not independent. A null text or one
    without letters is UNKNOWN with score 0, as is every text if no language is known. Of equal
    posteriors the first name wins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = pa.array([*known.languages, UNKNOWN], pa.string())
        for batch in batches:
            for part in byte_slices(batch, "text"):
                words = Words(letters(part.column("text")))
                best = np.full(part.num_rows, len(known.languages))
                score = np.zeros(part.num_rows)
                start, length, number = _distinct(words)
                lettered = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\p{L}"), False)
                if known.languages and len(start):
                    logs = log_likelihoods(words.data, start, length, known)
                    counts = np.bincount(words.owner, minlength=part.num_rows)
                    some = (counts > 0) & lettered.to_numpy(zero_copy_only=False)
                    total = np.stack(
                        [np.bincount(words.owner, column[number], part.num_rows) for column in logs.T], axis=1
                    )[some] / np.sqrt(counts[some])[:, None] + known.prior
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    best[some] = total.argmax(axis=1)
                    score[some] = odds.max(axis=1) / odds.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), names.take(pa.array(best)), pa.array(score)],
                    [*columns, "lang_pred", "score"],
                )

    kept = docs.select(*quoted(columns))
    result = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return map_arrow(kept, told, result)


def held_out(doc_id: str = "doc_id"):
    """Documents never learned from: crc32(doc_id as text) mod 4 is 2; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predict_languages(docs: DataFrame, vocabulary: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Each row's held_out, lang_pred and score, with the columns to `carry` (default: all).

    Learns from the text and the non-null lang of documents that are not held out. `docs` has
    the columns doc_id, text and lang. An empty table gives an empty table.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    train = docs.filter(~held_out()).filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    model = learn(train, path)
    added = ["held_out", "lang_pred", "score"]
    columns = [c for c in (docs.columns if carry is None else carry) if c not in added]
    needed = docs.withColumn("held_out", held_out()).select(*quoted(dict.fromkeys([*columns, "text", "held_out"])))
    return identify(needed, model).select(*quoted(columns), *added)
