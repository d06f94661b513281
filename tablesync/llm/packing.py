"""Documents packed into sequences by hierarchical best fit.

Tasks tokenize their documents, cut the long ones and pack the pieces of a group best-fit
decreasing. Sequences that are nearly full, or that nothing left over could fill, are final;
the others go on, as items that stay together, to a merged group of the next round. A group is
of bounded size from the start, and hands on at most a few sequences for each group it comes
from, so no round gathers the corpus.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import byte_slices, kept_between_tasks, map_arrow
from tablesync.sinks.files import stage

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
#: Pieces in a group of the first round, about.
GROUP = 20_000
#: Groups merged into one in each later round.
FAN_IN = 8
#: A sequence with fewer free tokens is full.
NEARLY_FULL = 16
#: Bytes from which on a generation of remembered words takes no more, about: most words of a
#: corpus are rare, so a worker gains little by holding more.
REMEMBERED = 16_000_000
#: Bytes that a remembered word takes besides its letters and ids, about.
WORD_BYTES = 200
#: Bytes of text that are tokenized at once.
SLICE = 1_000_000

#: A space at either end of a text, or beside other white space.
_ODD_SPACE = re.compile(r"\A | \Z|\s | \s")
#: White space that is neither a space nor a line feed.
_RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# How byte-level vocabularies cut a text, and the name of that rule.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RULE = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
# Fixed value: bytes that such vocabularies spell as the character of the same number; all
# others are spelled as the characters from 256 on.
_SAME = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> dict[str, int]:
    """The characters that spell bytes in a byte-level vocabulary, with their bytes."""
    others = [b for b in range(256) if b not in _SAME]
    return {chr(b): b for b in _SAME} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_pieces(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The pieces of a byte-level vocabulary as bytes; special tokens are left out."""
    number = byte_alphabet()
    return {bytes(map(number.__getitem__, t)): i for t, i in vocabulary.items() if all(c in number for c in t)}


def strung_encoder(tokenizer) -> tiktoken.Encoding | None:
    """A faster encoder with the same ids, or None unless the vocabulary has the byte-level cutting rule,
    no changes of the text, and merges whose results have ids in their order."""
    model = json.loads(tokenizer.to_str())["model"]
    if str(tokenizer.pre_tokenizer) != _RULE or tokenizer.normalizer is not None or model["type"] != "BPE":
        return None
    if model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    vocabulary, last = model["vocab"], -1
    for merge in model["merges"]:
        made = vocabulary.get(merge.replace(" ", "") if isinstance(merge, str) else "".join(merge), -1)
        if made <= last:
            return None
        last = made
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    pieces = byte_pieces({t: i for t, i in vocabulary.items() if t not in special})
    return tiktoken.Encoding("words", pat_str=_CUT, mergeable_ranks=pieces, special_tokens={})


class Encoder:
    """Ids of texts as little-endian bytes, each distinct word tokenized once.

    The byte-level rule cuts a text before every single space between two other characters, so
    such words can be tokenized apart, each with its space. New words are strung together and
    tokenized at once; the lengths of the pieces tell which ids are whose. A text with any other
    space is tokenized as a whole, as are all texts if the vocabulary has another rule. Two
    generations of words are remembered, so words in use stay; by their bytes, so memory is bounded
    whatever the words are.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenizer.encode_special_tokens = True
        self._strung = strung_encoder(self._tokenizer)
        self._by_words = self._strung is not None
        if self._by_words:
            special = {t.content for t in self._tokenizer.get_added_tokens_decoder().values()}
            pieces = byte_pieces({t: i for t, i in self._tokenizer.get_vocab().items() if t not in special})
            self._size = np.zeros(max(pieces.values()) + 1, np.int64)
            for piece, number in pieces.items():
                self._size[number] = len(piece)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0  # bytes of the words in _known, about

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Remember words that begin with a space."""
        new = []
        for word in words:
            ids = self._older.get(word)
            if ids is None:
                new.append(word)
            else:
                self._known[word] = ids
                self._held += len(word) + len(ids)
        self._held += WORD_BYTES * len(words)
        if new:
            ids = np.array(self._strung.encode_ordinary("".join(new)), "<u4")
            ends = np.cumsum([len(word.encode()) for word in new])
            edges = np.searchsorted(np.cumsum(self._size[ids]), ends) + 1
            body, start = ids.tobytes(), 0
            self._held += int(ends[-1]) + len(body)
            for word, edge in zip(new, (4 * edges).tolist(), strict=True):
                self._known[word] = body[start:edge]
                start = edge

    def encode(self, texts: Sequence[str]) -> Iterator[bytes]:
        """The ids of each text; the more texts at once, the better."""
        if self._held > REMEMBERED:
            # a run of texts that alone takes more, such as one very long text, is not kept at all
            self._known, self._older = {}, self._known if self._held <= 2 * REMEMBERED else {}
            self._held = 0
        apart: list[list[str] | None] = []
        unknown: list[str] = []
        known = self._known
        for text in texts:
            odd = "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
            odd = odd or (_RARE_SPACE.search(text) is not None and _ODD_SPACE.search(text) is not None)
            if odd or not self._by_words or not text or "\0" in text:
                apart.append(None)
                continue
            words = text.replace(" ", "\0 ").split("\0")
            apart.append(words)
            unknown += [w for w in words[1:] if w not in known]
        self._learn(list(set(unknown)))
        for text, words in zip(texts, apart, strict=True):
            if words is None:
                yield self._whole(text)
            else:
                yield self._whole(words[0]) + b"".join(map(known.__getitem__, words[1:]))


_ENCODERS: dict[str, Encoder] = kept_between_tasks(__name__)


def _encoder(vocabulary: str) -> Encoder:
    """One encoder for each Python worker, whose tasks have most words in common."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and ids (little-endian bytes) of each piece.

    A document is its ids and one end id. One that is longer than `capacity` is cut; the first
    piece takes what is over, all others are full.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                rows: dict[str, list] = defaultdict(list)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for at, ids in enumerate(encoder.encode(texts)):
                    ids += end
                    total = len(ids) // 4
                    first = total % capacity or capacity
                    for number, stop in enumerate(range(first, total + 1, capacity)):
                        start = max(0, stop - capacity)
                        body = ids[4 * start : 4 * stop]
                        for name, value in zip(_PIECE, (at, number, start, stop - start, zlib.crc32(body), body), strict=True):
                            rows[name].append(value)
                doc = part.column("doc_id").take(pa.array(rows["at"]))
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(rows["piece"], pa.int32()), pa.array(rows["start"]), pa.array(rows["length"]), pa.array(rows["ids_crc32"]), pa.array(rows["ids"], pa.binary())],
                    ["doc_id", *_PIECE[1:]],
                )

    return map_arrow(
        docs.select("doc_id", "text"), cut,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary",
    )


_PIECE = ["at", "piece", "start", "length", "ids_crc32", "ids"]


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the items of each bin: longest first, each into the fullest bin that takes it."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if a bin has r tokens left
    for item in order:
        length = lengths[item]
        above = open_rooms >> length
        if above:
            room = length + (above & -above).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        left = room - length
        if left:
            by_room[left].append(chosen)
            open_rooms |= 1 << left
    return bins


def _round(items: DataFrame, capacity: int, groups_below: int, last: bool) -> DataFrame:
    """Pack each `grp` of items (key, length, members) by itself.

    Bins that are at most half full, of which best fit leaves one at most, and as many of the
    emptiest others as groups are merged below, may still gain from other groups; they are
    `open`. All other bins are final.
    """

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "key"], ascending=[False, True], ignore_index=True)
        lengths, members, keys = frame["length"].tolist(), frame["members"].tolist(), frame["key"].tolist()
        out = []
        for chosen in best_fit(lengths, capacity):
            joined, offset = [], 0
            for i in chosen:
                joined += [{"item": m["item"], "offset": int(m["offset"]) + offset} for m in members[i]]
                offset += lengths[i]
            out.append((keys[chosen[0]], offset, joined))
        out.sort(key=lambda b: b[1])
        hands_on = 0 if last else sum(2 * b[1] <= capacity for b in out) + groups_below
        return pd.DataFrame({
            "key": [b[0] for b in out], "length": [b[1] for b in out], "members": [b[2] for b in out],
            "open": [i < hands_on and b[1] <= capacity - NEARLY_FULL for i, b in enumerate(out)], "grp": frame["grp"].iloc[0],
        })

    return items.groupBy("grp").applyInPandas(
        pack, "key bigint, length bigint, members array<struct<item:bigint,offset:bigint>>, open boolean, grp bigint"
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents with their places: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, and with `keep_ids` the ids as little-endian 32-bit numbers.

    `vocabulary` is the path of a tokenizer file (default: the public byte-level one). A null
    or empty text has its end id alone. doc_id may be null or repeated: each row is a document.
    An empty table gives an empty table.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    cut = pieces(docs, path, end_id, capacity)
    cut = stage((cut if keep_ids else cut.drop("ids")).withColumn("item", F.monotonically_increasing_id()), "pieces")
    full, rest = cut.filter(F.col("length") == capacity), cut.filter(F.col("length") < capacity)
    count = rest.count()
    groups = max(1, round(count / GROUP))
    items = rest.select(
        F.col("item").alias("key"), "length",
        F.array(F.struct("item", F.lit(0).cast("bigint").alias("offset"))).alias("members"),
        F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"),
    )
    done, below = [], 1
    while True:
        packed = stage(_round(items, capacity, below, groups == 1), "packed")
        done.append(packed.filter("not open").select("key", "members"))
        if groups == 1:
            break
        items = packed.filter("open").select("key", "length", "members", F.floor(F.col("grp") / FAN_IN).alias("grp"))
        groups, below = -(-groups // FAN_IN), below * FAN_IN
    bins = done[0]
    for more in done[1:]:
        bins = bins.union(more)
    placed = bins.select(F.col("key").alias("sequence_id"), F.inline("members"))
    joined = rest.join(placed, "item").unionByName(
        full.withColumn("sequence_id", F.col("item")).withColumn("offset", F.lit(0).cast("bigint"))
    )
    return joined.drop("item")
