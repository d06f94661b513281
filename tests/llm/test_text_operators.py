"""Exact dedup, mixing, shards, packing and near-dedup: awkward tables and plain versions."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import SCHEMA, awkward, empty, lower, words  # noqa: E402

from tablesync.llm import common, minhash, packing, sharding  # noqa: E402
from tablesync.llm.common import Words, byte_slices, mix64  # noqa: E402
from tablesync.llm.exact_dedup import chunks, exact_duplicates  # noqa: E402
from tablesync.llm.minhash import components, near_duplicates, super_min_hash  # noqa: E402
from tablesync.llm.mixing import mix_sources, poisson_steps  # noqa: E402
from tablesync.llm.packing import Encoder, best_fit, pack_documents  # noqa: E402
from tablesync.llm.sharding import kd_shards  # noqa: E402


def texts(seed, count, alphabet, most):
    pick = random.Random(seed)
    return [None if pick.random() < 0.05 else "".join(pick.choices(alphabet, k=pick.randint(0, most))) for _ in range(count)]


@pytest.mark.parametrize("bounds", [(0, 200), (7, 60), (199, 200), (5, 5)])
def test_words_of_sliced_arrays(bounds):
    known = texts(1, 200, ["a", "B", "Z", " ", "\t", "\n", ".", "é", "\x0b", "\x1c"], 30)
    part = known[bounds[0] : bounds[1]]
    found = Words(pa.array(known, pa.string()).slice(bounds[0], len(part)))
    for t, text in enumerate(part):
        own = range(found.first[t], found.first[t + 1])
        assert [bytes(found.data[found.start[w] : found.end[w]]).decode() for w in own] == words(text)
    assert len(np.unique(found.hashes())) == len({w for t in part for w in words(t)})


def test_slices_cover_a_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 500, 0, 30, 30)]})
    parts = list(byte_slices(batch, "text", 60))
    assert [p.num_rows for p in parts] == [1, 1, 3]


# exact dedup ---------------------------------------------------------------------------------


def test_chunks_are_the_text(spark):
    known = [t for t in texts(2, 40, list("abcdefgou0159 \n.,"), 4000) if t]
    df = spark.createDataFrame([(t,) for t in known], "text string")
    cut = df.select("text", chunks(F.col("text"), 40, 400).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in cut) and max(len(r.c) for r in cut) > 5


def test_a_change_moves_few_chunks(spark):
    text = "".join(random.Random(3).choices("abcdefgou0159 \n.,", k=30_000))
    df = spark.createDataFrame([(text,), ("xyz" + text,)], "text string")
    first, second = (set(r.c) for r in df.select(chunks(F.col("text"), 40, 400).alias("c")).collect())
    assert len(first & second) > 0.9 * len(first)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(spark, weak):
    """Also when chunk names clash all the time."""
    df = awkward(spark, "keep_id kept copies")
    name = {"name": lambda c: F.unhex(F.hex(F.length(c) % 3))} if weak else {}
    found = exact_duplicates(df, **name)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies", "keep_id", "group_size", "kept", "text_sha256"]
    rows = found.collect()
    assert len(rows) == df.count()
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r.text)].append(r)
    for norm, own in groups.items():
        ids = [r.doc_id for r in own if r.doc_id is not None]
        assert {r.keep_id for r in own} == {max(ids) if ids else None}
        assert {r.group_size for r in own} == {len(own)} and sum(r.kept for r in own) == 1
        assert all(r.doc_id == r.keep_id for r in own if r.kept)
        assert {r.text_sha256 for r in own} == {hashlib.sha256(norm.encode()).hexdigest()}


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(empty(spark)).count() == 0


# mixing --------------------------------------------------------------------------------------


def test_poisson_steps_are_a_distribution():
    for rate in (0.0, 0.01, 1.0, 7.5, 900.0):
        steps = poisson_steps(rate)
        assert steps == sorted(steps) and steps[-1] > 1 - 1e-12
        mean = sum(k * (b - a) for k, (a, b) in enumerate(zip([0.0, *steps], steps)))
        assert math.isclose(mean, rate, rel_tol=1e-6, abs_tol=1e-9)


def test_mix_meets_the_weights(spark):
    df = spark.range(6000).selectExpr(
        "id as doc_id", "repeat('x', cast(id % 90 as int)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source",
        "id as copy",
    )
    found = mix_sources(df, {"hot": 0.2, "s1": 0.5}, rest=0.3)
    assert found.columns == ["doc_id", "text", "source", "repeat_rate", "n_copies", "copy", "shuffle_key"]
    sizes = {r.s: r.n for r in found.selectExpr("if(source in ('hot', 's1'), source, 'rest') as s", "length(text) + 1 as b").groupBy("s").agg(F.sum("b").alias("n")).collect()}
    total = sum(sizes.values())
    for source, share in (("hot", 0.2), ("s1", 0.5), ("rest", 0.3)):
        assert abs(sizes[source] / total - share) < 0.03
    per_doc = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_copies").alias("m"), F.countDistinct("copy").alias("c"))
    assert per_doc.where("n <> m or n <> c").count() == 0
    again = mix_sources(df.repartition(3), {"hot": 0.2, "s1": 0.5}, rest=0.3)
    assert sorted(map(tuple, again.select("doc_id", "copy").collect())) == sorted(map(tuple, found.select("doc_id", "copy").collect()))


def test_mix_of_awkward_rows(spark):
    found = mix_sources(awkward(spark, "n_copies other"), {"hot": 1.0}, rest=1.0, total=50_000_000)
    copies = found.groupBy("doc_id", "source").count().collect()
    assert {(r.doc_id, r.source) for r in copies} >= {(8, "hot"), (3, "b"), (None, None), (None, "hot")}
    assert "other" in found.columns and found.columns.count("n_copies") == 1
    assert mix_sources(empty(spark)).count() == 0
    assert mix_sources(awkward(spark), {"hot": 1.0}, rest=0.0).where("source is null or source <> 'hot'").count() == 0


# shards --------------------------------------------------------------------------------------


def test_shards_are_even_and_keep_equal_texts(spark):
    df = spark.range(8000).selectExpr(
        "id as doc_id", "repeat(substr(md5(cast(if(id % 4 = 0, id div 40, id) as string)), 1, 8), 1 + cast(id % 9 as int) div 4) as text"
    )
    found = kd_shards(df, shards=7).toPandas()
    total = found.groupby("shard")["size"].sum()
    assert len(total) == 7 and total.max() / total.mean() < 1.03 and total.min() / total.mean() > 0.97
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert (found.groupby("text_crc32").shard.nunique() > 1).mean() < 0.02


def test_a_hot_group_is_cut(spark):
    df = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', concat('text ', id)) as text")
    found = kd_shards(df, shards=6).toPandas()
    total = found.groupby("shard")["size"].sum()
    assert len(total) == 6 and total.max() / total.min() < 1.1


@pytest.mark.parametrize("number", ["null", "7L"])
def test_equal_rows_without_a_number_of_their_own_are_cut(spark, number):
    df = spark.range(4400).selectExpr(f"if(id < 4000, {number}, id) as doc_id", "if(id < 4000, 'copied', concat('own text ', id)) as text")
    found = kd_shards(df, shards=8).toPandas()
    total = found.groupby("shard")["size"].sum()
    assert len(total) == 8 and total.max() / total.mean() < 1.03 and total.min() / total.mean() > 0.97
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_cuts_equal_plain_weighted_medians(spark):
    """Each inner node against a plain walk over its rows: the widest dimension is cut next to the median."""
    df = spark.range(3000).selectExpr("id as doc_id", "repeat(concat('x', id % 97, '\\n'), 1 + cast(id % 23 as int)) as text")
    meta = sharding.stage(sharding.metadata(df), "test-metadata")
    rows, tree = meta.toPandas(), sharding.build_tree(meta, 6)
    extent = {d: rows[d].max() - rows[d].min() for d in sharding.DIMENSIONS}

    def walk(node, own):
        if node.left is None:
            return
        widest = max((own[d].max() - own[d].min()) / extent[d] for d in sharding.DIMENSIONS)
        assert (own[node.dimension].max() - own[node.dimension].min()) / extent[node.dimension] == widest
        goes = (own[node.dimension] < node.cut) | ((own[node.dimension] == node.cut) & (own.row_hash <= node.row_cut))
        goal = own["size"].sum() * (node.leaves // 2) / node.leaves
        group = own.groupby(node.dimension)["size"].sum().max()
        assert abs(own["size"][goes].sum() - goal) <= max(group, 0.02 * own["size"].sum() / node.leaves)
        walk(node.left, own[goes])
        walk(node.right, own[~goes])

    walk(tree, rows)


def test_shards_of_awkward_rows(spark):
    df = awkward(spark, "shard slot size")
    found = kd_shards(df, shards=3).collect()
    assert len(found) == df.count()
    sizes = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == sizes
    assert kd_shards(empty(spark), shards=40).count() == 0
    assert kd_shards(df, target_bytes=10**9).select("shard").distinct().count() == 1
    with pytest.raises(ValueError):
        kd_shards(df)


# packing -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    return known


def test_encoder_gives_the_ids_of_the_tokenizer(tokenizer, monkeypatch):
    import public_tokenizers

    import tablesync.llm.packing as packing

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    parts = ["a", "B", "don't", " ", " ", "\n", "\t", "7", "é", "..", "　", "中", "\x1c", "​", "<|endoftext|>", "'s", "²", "_", "\0", "\r"]
    known = [t or "" for t in texts(4, 3000, parts, 14)]
    for start in range(0, len(known), 500):
        some = known[start : start + 500]
        for text, ids in zip(some, encoder.encode(some), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_remembers_words_by_their_bytes(tokenizer, monkeypatch):
    """Few long words take as much memory as many short ones; one huge run of texts is not kept."""
    import public_tokenizers

    monkeypatch.setattr(packing, "REMEMBERED", 100_000)
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(7)
    held = []
    for run in range(60):
        some = ["a " + " ".join("%x" % draw.getrandbits(4000) for _ in range(1000 if run == 30 else 10)) + " b"]
        ids = list(encoder.encode(some))
        assert np.frombuffer(ids[0], "<u4").tolist() == tokenizer.encode(some[0], add_special_tokens=False).ids
        held.append(sum(len(word) + len(ids) for known in (encoder._known, encoder._older) for word, ids in known.items()))
    assert max(held[:30] + held[31:]) < 400_000


@pytest.mark.parametrize("order, strung", [([("a", "b"), ("b", "c")], True), ([("b", "c"), ("a", "b")], False)])
def test_merges_out_of_the_order_of_ids_are_noticed(order, strung):
    """With merges in another order than the ids of what they make, ranks would give other ids."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = [*packing.byte_alphabet(), "ab", "bc"]
    model = models.BPE(vocab={t: i for i, t in enumerate(letters)}, merges=order)
    known = Tokenizer(model)
    known.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    found = packing.strung_encoder(known)
    assert (found is not None) == strung
    if strung:
        for text in ("abc", " bcab ab", "cabbc"):
            assert found.encode_ordinary(text) == known.encode(text, add_special_tokens=False).ids


def test_best_fit_fills_bins():
    lengths = random.Random(5).choices(range(1, 100), k=500)
    bins = best_fit(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 100
    assert len(bins) <= 1.05 * sum(lengths) / 100


def _check_packing(found, df, tokenizer, capacity):
    ids = {}
    rows = df.select("doc_id", "text").collect()
    for r in rows:
        own = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(own) % capacity or capacity
        for n, stop in enumerate(range(first, len(own) + 1, capacity)):
            start = max(0, stop - capacity)
            piece = (r.doc_id, n, start, stop - start, zlib.crc32(own[start:stop].tobytes()))
            ids[piece] = ids.get(piece, 0) + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == Counter(ids)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_of_awkward_rows(spark, tokenizer):
    df = awkward(spark, "piece offset")
    found = pack_documents(df, capacity=64).collect()
    n = _check_packing(found, df, tokenizer, 64)
    assert n <= -(-sum(r.length for r in found) // 64) + 1
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in found)
    assert pack_documents(empty(spark)).count() == 0


def test_packing_in_rounds(spark, tokenizer, monkeypatch):
    import tablesync.llm.packing as packing

    monkeypatch.setattr(packing, "GROUP", 60)
    monkeypatch.setattr(packing, "FAN_IN", 3)
    df = spark.range(900).selectExpr("id as doc_id", "repeat('word ', 1 + cast(id * 7 % 31 as int)) as text")
    found = pack_documents(df, capacity=64, keep_ids=False).collect()
    n = _check_packing(found, df, tokenizer, 64)
    assert n <= 1.03 * sum(r.length for r in found) / 64


# near-dedup ----------------------------------------------------------------------------------


def _plain_super_min_hash(shingles, slots):
    """The same draws, one shingle and one swap at a time."""
    kept = [2**64 - 1] * slots
    step = 0x9E3779B97F4A7C15
    mixed = lambda v: int(mix64(np.array([v % 2**64], np.uint64))[0])
    for shingle in shingles:
        base, order = mixed(shingle ^ 0x5851F42D4C957F2D), list(range(slots))
        for rank in range(slots):
            u = mixed(base + (2 * rank + 1) * step)
            spot = rank + ((mixed(u) >> 32) * (slots - rank) >> 32)
            order[rank], order[spot] = order[spot], order[rank]
            kept[order[rank]] = min(kept[order[rank]], rank << 48 | u >> 16)
    return kept


@pytest.mark.parametrize("sizes", [[1, 2, 0, 9], [40, 3, 150]])
def test_signatures_equal_the_plain_algorithm(sizes):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in sizes]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    found = super_min_hash(np.concatenate(sets), owner, len(sets), 24)
    for own, row in zip(sets, found, strict=True):
        assert row.tolist() == _plain_super_min_hash(own.tolist(), 24)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[500:])
    kept = super_min_hash(np.r_[a, b], np.repeat([0, 1], [len(a), len(b)]), 2, 1024)
    assert abs((kept[0] == kept[1]).mean() - 1 / 3) < 0.06


def test_components(spark):
    pick = random.Random(8)
    links = [(pick.randrange(400), pick.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in list(root)}


def _similar(texts_by_id, size, percent):
    sets = {}
    for i, text in texts_by_id.items():
        w = words(text)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    pick = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    known = {}
    for group in range(25):
        base = pick.choices(vocabulary, k=pick.choice([3, 30, 120]))
        for _ in range(pick.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 6, 20])):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            known[len(known)] = " ".join(copy)
    df = spark.createDataFrame([(i, t) for i, t in known.items()], "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, words=size).collect()}
    assert found == _similar(known, size, 80)


def thue_morse(size, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(size))


@pytest.mark.parametrize("size", [64, 512, 1023, 1024, 4096])
def test_words_made_for_polynomial_hashes_are_told_apart(spark, size):
    """A Thue-Morse word and its complement have one value under any base modulo 2^64."""
    pair = [thue_morse(size, "ab"), thue_morse(size, "ba")]
    known = Words(pa.array([f"{pair[0]} x {pair[0]}", pair[1]])).hashes()
    assert known[0] == known[2] != known[3]
    df = spark.createDataFrame([(1, f"{pair[0]} same"), (2, f"{pair[1]} same")], "doc_id bigint, text string")
    assert near_duplicates(df, words=2).where("kept").count() == 2


def test_members_of_the_largest_component_never_meet(spark):
    """2,000 members of one bucket, all but ten of one component."""
    members = spark.range(2000).selectExpr("7L as key", "id as rep", "if(id < 10, id, 100L) as root", "100L as most")
    met = minhash._meetings(members)
    assert met.count() == 10 * 1990 + 45
    assert met.selectExpr("least(repa, repb)", "greatest(repa, repb)").distinct().count() == met.count()
    assert members.filter("root <> most").join(members.select("key"), "key").count() == 10 * 2000  # pairs tested


def test_near_duplicates_of_a_hot_group(spark):
    """Copies with more and more of their own: some links lead through other copies only."""
    pick = random.Random(10)
    base = [f"w{i}" for i in range(150)]
    known = {}
    for i in range(260):
        copy = list(base)
        for at in pick.sample(range(150), pick.choice([1, 3, 6, 9, 14])):
            copy[at] = f"own{i}x{at}"
        known[i] = " ".join(copy)
    df = spark.createDataFrame([(i, t) for i, t in known.items()], "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, words=2).collect()}
    assert found == _similar(known, 2, 80)


def test_near_duplicates_of_awkward_rows(spark):
    df = awkward(spark, "component_id kept node digest")
    rows = near_duplicates(df, words=2).collect()
    assert len(rows) == df.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert {r.component_id for i in (1, 2, 9) for r in by_id[i]} == {1}
    assert [r.component_id for r in by_id[6]] == [6] and {r.component_id for r in by_id[7]} == {6}
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id and r.kept for i in (3, 4, 5) for r in by_id[i])
    assert [(r.n_shingles, r.component_id) for i in (11, 12) for r in by_id[i]] == [(1, 11), (1, 11)]
    assert all(r.kept and r.component_id is None for r in by_id[None])
    assert near_duplicates(empty(spark)).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, "a b c", "", "", 1)], SCHEMA)).count() == 1


def test_a_worker_keeps_nothing_for_tasks_of_other_modules(spark):
    """The encoder with its words is there for the next packing task, and gone once another operator's task runs."""
    kept = common.kept_between_tasks("packing")
    kept["words"] = list(range(1000))
    common.drop_kept_by_others("packing")
    assert kept
    common.drop_kept_by_others("langid")
    assert not kept
    assert packing._ENCODERS is common.kept_between_tasks("tablesync.llm.packing")
