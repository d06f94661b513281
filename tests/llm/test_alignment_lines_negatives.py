"""Cross-tokenizer alignment, line dedup and hard negatives: plain versions and awkward tables."""

import base64
import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import LOWER, awkward, empty  # noqa: E402

from tablesync.llm import alignment, hard_negatives, line_dedup  # noqa: E402

BLANKS = " \t\n\x0b\x0c\r"

# alignment -----------------------------------------------------------------------------------


def plain_tokens():
    """A function from a text to ids and spelled tokens of both vocabularies, from other files where there are any."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    spelled = {i: piece for piece, i in ranks.items()}
    a = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[1:-1], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text):
        ids = a.encode_ordinary(" " + text), b.encode(text)
        return ids, ([spelled[i] for i in ids[0]], [piece(i) for i in ids[1]])

    return tokens


def plain_alignments(texts):
    tokens, counts, found = plain_tokens(), Counter(), []
    for text in texts:
        groups, links = [], []
        if text:
            ids, spelled = tokens(text)
            if all(b"".join(s) == (" " + text).encode() for s in spelled):
                ends = [np.cumsum([len(t) for t in s]).tolist() for s in spelled]
                start = [0, 0]
                for end in sorted(set(ends[0]) & set(ends[1])):
                    stop = [e.index(end) + 1 for e in ends]
                    groups.append("|".join(",".join(map(str, i[s:e])) for i, s, e in zip(ids, start, stop, strict=True)))
                    links.append((ids[0][stop[0] - 1], ids[1][stop[1] - 1]))
                    start = stop
                found.append((len(ids[0]), len(ids[1]), groups, links))
                counts.update(links)
                continue
        found.append((0, 0, [], []))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (
            a, b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for a, b, groups, links in found
    ]


def mixed_texts(seed, count):
    pick = random.Random(seed)
    parts = ["the", "Straße", "naïve", " ", "  ", "\n", "\t", "don't", "123", "中文", "𝔘", "é", "é", "▁", "<s>", "<|endoftext|>", "<0x41>", " ", "　", "\x1c", "-", "...", "running", "́"]
    return ["".join(pick.choices(parts, k=pick.randint(0, 30))) for _ in range(count)] + ["", None, " ", "▁", "a▁b", "<unk>"]


@pytest.mark.parametrize("sent", [alignment.BROADCAST_PAIRS, 0])
def test_alignments_equal_plain_ones(spark, sent, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD", 40)
    monkeypatch.setattr(alignment, "VECTOR_ROWS", 5)
    texts = mixed_texts(1, 300)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    rows = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(df, broadcast_pairs=sent).collect()}
    assert [rows[i] for i in range(len(texts))] == plain_alignments(texts)


def test_long_texts_are_aligned_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 50)
    monkeypatch.setattr(alignment, "REMEMBERED", 2000)
    texts = ["word " * 400 + "end", "x" * 500, "a  b\n c " * 60, *mixed_texts(2, 40)]
    for text in texts:
        if text:
            parts = [w for part in alignment.words(text) for w in part]
            assert " ".join(parts) == text and all(len(" ".join(p)) < 600 for p in alignment.words(text))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    rows = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(df).collect()}
    assert [rows[i] for i in range(len(texts))] == plain_alignments(texts)


def test_perfect_hash_is_minimal_and_told_from_other_keys():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**46, 5000))
    places = alignment.PerfectHash(alignment.perfect_hash(keys)).places(keys)
    assert sorted(places) == list(range(len(keys)))
    body = alignment._dump(
        keys=keys[np.argsort(places)], bits=np.packbits(np.concatenate(alignment.perfect_hash(keys))),
        sizes=np.array([len(level) for level in alignment.perfect_hash(keys)]),
    )
    counts = np.arange(1, len(keys) + 1)
    table = alignment.PairCounts({0: (body, counts.tobytes())}, 1, np.zeros(1, np.int64))
    asked = np.r_[keys[:50], keys[:50] + 2**50]
    assert (table.of(asked)[0] == np.r_[counts[places[:50]], np.zeros(50, int)]).all()


def test_alignment_of_awkward_rows(spark):
    df = awkward(spark, "n_a groups_sha256 a.b _row")
    found = alignment.align_documents(df)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "a.b", *alignment._FACTS, "groups_sha256"]
    expected = Counter(zip([r.doc_id for r in df.collect()], plain_alignments([r.text for r in df.collect()]), strict=True))
    assert Counter((r.doc_id, tuple(r)[5:]) for r in found.collect()) == expected
    assert alignment.align_documents(empty(spark)).count() == 0


# lines ---------------------------------------------------------------------------------------


def plain_kept(rows, least_chars=40, least_docs=5):
    """The lines that each row keeps; rows that share a doc_id are one document."""
    def key(line):
        return line.strip(BLANKS).translate(LOWER)

    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(doc)

    def best(docs):
        return max(docs, key=lambda d: (d is not None, d or 0))

    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        shared = [len(held.get(key(x), ())) >= least_docs and best(held[key(x)]) != doc for x in lines]
        out.append((len(lines), sum(shared), "\n".join(x for x, gone in zip(lines, shared, strict=True) if not gone)))
    return out


@pytest.mark.parametrize("few", [0, 500_000])
def test_lines_equal_plain_ones(spark, few, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", few)
    pick = random.Random(4)
    lines = [f"Line {n:02d} of those that many documents SHARE, é" for n in range(8)] + ["short", "", " \t", "x" * 39, "é" * 40]
    rows = []
    for doc in range(60):
        chosen = [pick.choice(["", " ", "\r"]) + x.swapcase() * (x != "short") + pick.choice(["", " \x0b"]) for x in pick.choices(lines, k=pick.randint(0, 30))]
        rows.append((doc, "\n".join(chosen + [f"own line of document {doc}, long enough to count"])))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, lines[0].upper())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_shared_lines(df).collect()}
    assert [found[doc] for doc, _ in rows] == plain_kept(rows)
    assert any(n > 1 for _, n, _ in found.values())


def test_bitmaps_are_run_lengths_and_come_back(spark):
    pick = random.Random(5)
    sets = [[0], [3], [0, 1, 2, 5, 9, 10], [127, 128], [16383, 16384, 70_000], sorted(pick.sample(range(3000), 1500))]
    df = spark.createDataFrame([(s, max(s) + 2) for s in sets], "p array<int>, n int")
    bitmap = line_dedup.run_lengths(F.col("p"))
    lines = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i.cast("string"))
    for row in df.select("p", "n", F.octet_length(bitmap).alias("size"), line_dedup.kept_lines(lines, bitmap).alias("kept")).collect():
        assert [int(k) for k in row.kept] == [i for i in range(row.n) if i not in set(row.p)]
    assert df.select(bitmap.alias("b")).first().b == bytes([0, 1])


def test_a_line_of_a_third_of_all_documents_spreads(spark):
    df = spark.range(9000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('hot ', 20), concat(repeat('own ', 10), id)) as text")
    rows = line_dedup.first_occurrences(line_dedup.line_digests(df, 40))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 3000 and rows.where("first").count() == 9000
    found = line_dedup.drop_shared_lines(df)
    assert found.where("n_dropped > 0").count() == 2999 and found.where("doc_id = 8997 and n_dropped = 0").count() == 1


def test_lines_of_awkward_rows(spark):
    hot = "a line without a number that stands in very many rows"
    df = awkward(spark, "n_lines keep a.b")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    more = spark.createDataFrame([(n, f"{hot}\n{n}", None, None, 1) for n in [None, None, 20, 21, 22, 23, 23]], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    both = df.unionByName(more, allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in both.collect()]
    found = line_dedup.drop_shared_lines(both)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "a.b", "text", "n_lines", "n_dropped", "keep"]
    expected = Counter((doc, *kept) for (doc, _), kept in zip(rows, plain_kept(rows), strict=True))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()) == expected
    assert line_dedup.drop_shared_lines(empty(spark)).count() == 0


# hard negatives ------------------------------------------------------------------------------


def plain_negatives(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    width = max(len(x) for _, _, x in rows)
    ids, labels = [r[0] for r in rows], [r[1] for r in rows]
    x = np.array([list(r[2]) + [0] * (width - len(r[2])) for r in rows], object)
    out = set()
    for a in range(len(rows)):
        if not is_anchor(ids[a]):
            continue
        score = x @ x[a]
        order = sorted(range(len(rows)), key=lambda i: (-score[i], ids[i]))
        for p in [i for i in order if labels[i] == labels[a] and ids[i] != ids[a]][:positives]:
            fits = [i for i in order if labels[i] != labels[a] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out |= {(ids[a], ids[p], k, ids[i], score[p], score[i]) for k, i in enumerate(fits[:negatives], 1)}
    return out


@pytest.mark.parametrize("scale, small", [(1, False), (1, True), (600_000, True)])
def test_negatives_equal_plain_ones(spark, scale, small, monkeypatch):
    if small:
        monkeypatch.setattr(hard_negatives, "BLOCK", 7)
        monkeypatch.setattr(hard_negatives, "TILE", 20)
    pick = np.random.default_rng(6)
    centres = pick.integers(-40, 90, (4, 6))
    rows = [(i, int(pick.integers(0, 3)), (centres[pick.integers(0, 4)] + pick.integers(-9, 9, 6)) * scale) for i in range(400)]
    rows = [(i, label, [int(v) for v in x][: 6 - (i % 40 == 3)]) for i, label, x in rows]
    df = spark.createDataFrame(rows, "vec_id bigint, label bigint, x array<bigint>").repartition(6)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 11 == 0)
    assert {tuple(r) for r in found.collect()} == plain_negatives(rows, lambda i: i % 11 == 0)


def test_bounds_along_the_tree_spare_scores():
    """Anchors close to each other: few candidates can be among the best of a child."""
    pick = np.random.default_rng(7)
    anchors = 100 * pick.integers(-10, 10, 8) + pick.integers(-3, 4, (40, 8))
    order, parent, length = hard_negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(40)) and (parent < 0).sum() == 1
    assert all(list(order).index(parent[i]) < list(order).index(i) for i in range(40) if parent[i] >= 0)
    tile = {"ids": np.arange(1000, 3000), "labels": np.zeros(2000, int), "x": pick.integers(-200, 200, (2000, 8))}
    block = {"ids": np.arange(40), "labels": np.zeros(40, int), "x": anchors, "order": order, "parent": parent, "length": length}
    candidates = hard_negatives.Candidates(tile, block, np.float64)
    best = [hard_negatives.Best(5) for _ in range(40)]
    hard_negatives.find_positives(candidates, block, best)
    assert candidates.scored < 0.3 * 40 * 2000
    for anchor in range(40):
        scores = tile["x"] @ anchors[anchor]
        assert best[anchor].ids.tolist() == tile["ids"][np.lexsort((tile["ids"], -scores))[:5]].tolist()


def test_vectors_that_are_left_out_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, [1.0, 0.7], 1), (4, None, 1),
        (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, None], 1), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (9, [], 1),
        (10, [-1.0, -1.0], 0), (11, [0.9, 0.9], 1), (1, [1.0, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("x", F.lit(1)).withColumn("rank", F.lit(2))
    vectors = hard_negatives.labelled_vectors(df)
    assert vectors.count() == 9
    found = sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors, F.col("vec_id") == 0).collect())
    top = 2 * 256**2
    assert found == [(0, 1, 1, 2, top, top), (0, 1, 2, 2, top, top), (0, 1, 3, 11, top, 2 * 230 * 256), (0, 1, 4, 3, top, (256 + 179) * 256)]
    assert hard_negatives.hard_negatives(vectors, F.col("vec_id") < 0).count() == 0
    assert hard_negatives.hard_negatives(vectors.limit(0), F.col("vec_id") == 0).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(vectors.withColumn("x", F.transform("x", lambda v: v * 2**40)), F.col("vec_id") == 0)
