"""Language-model scores, surrogates, license scans, top-k search, language ID, the pipeline."""

import math
import random
import re
import sys
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import __spark_entry__ as entry
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from oracle import compare, connect
from pyspark.sql import Row
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, empty, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from conftest import DATA  # noqa: E402
from tablesync.llm import langid, licenses, queries, suffix_tree, surrogates  # noqa: E402
from tablesync.llm.common import Words  # noqa: E402
from tablesync.llm.metric_tree import integer_vectors, top_k  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(DATA), DATA, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_all_operators_are_registered():
    numbers = Counter(re.match(r"op(\d+)_", n)[1] for n in entry.queries() if re.match(r"op\d+_", n))
    assert numbers == Counter(str(n) for n in range(1, 14)) and "pipeline" in entry.queries()


# scores --------------------------------------------------------------------------------------


def test_base_scores_equal_a_plain_count(spark):
    df = awkward(spark, "score n_known row")
    rows = df.collect()
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for r, h in zip(rows, held) if not h for w in [*words(r.text), "\0end"])
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for r, h in zip(rows, held, strict=True):
        own = [*words(r.text), "\0end"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        expected[r.doc_id, h, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)] += 1
    found = suffix_tree.score_texts(df).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert all(r.score < 0 for r in found)
    assert suffix_tree.score_texts(empty(spark)).count() == 0


def test_probabilities_of_next_symbols_add_up_to_one(spark):
    text = "the cat sat on the mat and the dog sat on the log "
    tree = suffix_tree.learn(spark.createDataFrame([(text * 20,), ("été " * 30,)], "text string"))
    assert sum(len(c) for c in tree.contexts[1:]) > 10
    for past in (b"", b"the ca", b"zzz", b"on the ", "é".encode()):
        stream = suffix_tree.Stream(Words(pa.array([past.decode() + "x"]))).code
        context = np.uint64(stream[len(past.strip())] >> np.uint64(8)) << np.uint64(8)
        chances = tree.probability(context | np.arange(256, dtype=np.uint64))
        assert math.isclose(chances.sum(), 1, rel_tol=1e-9) and chances.min() > 0


def test_streams_hold_whole_texts():
    stream = suffix_tree.Stream(Words(pa.array(["Ab  c", None, "", "d"])))
    symbols = [bytes((stream.code[a:b] & np.uint64(255)).astype(np.uint8)) for a, b in zip(stream.first[:-1], stream.first[1:])]
    assert symbols == [b"ab c\t", b"\t", b"\t", b"d\t"]


def test_codes_hold_the_bytes_before_each_symbol():
    pick = random.Random(4)
    texts = [None if pick.random() < 0.1 else "".join(pick.choices("aB é\t\n\x0b\x0c\r  中\0", k=pick.randrange(14))) for _ in range(500)]
    stream = suffix_tree.Stream(Words(pa.array(texts, pa.string())))
    expected = []
    for text in texts:
        past = b"\n" * 6 + b"\t" + " ".join(words(text)).encode() + b"\t"
        expected += [int.from_bytes(past[at - 7 : at + 1]) for at in range(7, len(past))]
    assert stream.code.tolist() == expected
    codes = suffix_tree._near_first(stream.code)
    assert (suffix_tree._far_first(codes) == stream.code).all()


def test_the_tree_predicts_held_out_text_better_than_words(spark):
    pick = random.Random(1)
    rows = []
    for i in range(300):
        at, own = pick.randrange(30), []
        for _ in range(60):
            at = (7 * at + 3) % 30 if pick.random() < 0.9 else pick.randrange(30)
            own.append("bdfgkl"[at % 6] + "aeiou"[at // 6] + "n")
        rows.append((i, " ".join(own)))
    found = suffix_tree.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sums = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


@pytest.mark.parametrize("share", [0.0, 1e-3, 1.0])
def test_scores_equal_those_of_the_whole_tree(spark, table, monkeypatch, share):
    """Whether grams are known to every task or joined, and wherever their states are learned."""
    monkeypatch.setattr(suffix_tree, "LEAST_GRAM", share)
    docs = table("documents").select("doc_id", "text").union(awkward(spark).select("doc_id", "text"))
    rows = docs.collect()
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    tree = suffix_tree.learn(docs.filter(~held))
    assert sum(len(c) for c in tree.contexts[suffix_tree.KEY :]) > 100
    stream = suffix_tree.Stream(Words(pa.array([r.text for r in rows], pa.string())))
    expected = np.add.reduceat(np.log10(tree.probability(stream.code)), stream.first[:-1])
    found = suffix_tree.score_texts(docs).collect()
    key = lambda pair: (pair[0] is None, pair[0] or 0, pair[1])
    expected = sorted(((r.doc_id, e) for r, e in zip(rows, expected, strict=True)), key=key)
    found = sorted(((r.doc_id, r.score) for r in found), key=key)
    assert [f[0] for f in found] == [e[0] for e in expected]
    assert np.allclose([f[1] for f in found], [e[1] for e in expected], rtol=1e-9)


def _texts(seed, count):
    pick = random.Random(seed)
    names = ["".join(pick.choices("abcdefgh", k=pick.randrange(2, 9))) for _ in range(3000)]
    return [" ".join(pick.choices(names, k=400)) for _ in range(count)]


def test_grams_cross_the_cluster_in_few_bytes(monkeypatch):
    """Once for each task, sorted by part, and in less than half of the eight bytes of a gram, its counts included."""
    batch = pa.record_batch({"text": _texts(1, 100), "held_out": [i % 7 == 2 for i in range(100)]})
    code = suffix_tree.Stream(Words(batch.column("text"))).code
    monkeypatch.setattr(suffix_tree, "PART_SYMBOLS", 10_000)
    edges = suffix_tree._edges(*np.unique(code & np.uint64(0xFFFFFF), return_counts=True))
    assert len(edges) > 5
    monkeypatch.setattr(suffix_tree, "SLICE", 10_000)
    (sent,) = suffix_tree._count_grams(edges)(iter([batch]))
    assert sent.num_rows <= len(edges) + 1
    assert sent.nbytes < 4 * len(np.unique(code))
    for row in sent.to_pylist():
        codes = suffix_tree._unpack_ascending(row["codes"], row["size"])
        assert (np.searchsorted(edges, codes, side="right") == row["part"]).all()
    monkeypatch.setattr(suffix_tree, "HELD", 3_000)
    monkeypatch.setattr(suffix_tree, "PIECE", 100)
    more = list(suffix_tree._count_grams(edges)(iter([batch])))
    assert len(more) > 1
    train = np.repeat([i % 7 != 2 for i in range(100)], np.diff(suffix_tree.Stream(Words(batch.column("text"))).first))
    expected, expected_train = Counter(code.tolist()), Counter(code[train].tolist())
    for batches in ([sent], more):
        found, counts = suffix_tree._unpacked([Row(**row) for b in batches for row in b.to_pylist()])
        found = suffix_tree._far_first(found).tolist()
        assert dict(zip(found, counts[:, 0].tolist(), strict=True)) == expected
        assert dict(zip(found, counts[:, 1].tolist(), strict=True)) == {c: expected_train[c] for c in expected}


@pytest.mark.parametrize("held", [300, 5_000_000])
def test_scores_are_the_same_from_many_parts(spark, monkeypatch, held):
    """Also if tasks hand grams and sums on before their end."""
    rows = [(i, text) for i, text in enumerate(_texts(2, 60))] + [(None, None), (3, ""), (5, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(suffix_tree, "LEAST_GRAM", 1e-4)
    whole = sorted((str(r.doc_id), r.n_tokens, r.score) for r in suffix_tree.score_texts(docs).collect())
    for name, value in {"PART_SYMBOLS": 2_000, "PIECE": 50, "SLICE": 5_000, "HELD": held}.items():
        monkeypatch.setattr(suffix_tree, name, value)
    parts = sorted((str(r.doc_id), r.n_tokens, r.score) for r in suffix_tree.score_texts(docs).collect())
    assert [p[:2] for p in parts] == [w[:2] for w in whole]
    assert np.allclose([p[2] for p in parts], [w[2] for w in whole], rtol=1e-9)


def test_contexts_are_kept_by_count_whatever_the_size_of_the_corpus():
    """A context of seven bytes seen ten times among 10^9 symbols is a state."""
    code = np.frombuffer(b"abcdefgx"[::-1] + b"\0\0\0\0\0\0ez" [::-1], np.uint64).copy()
    code = np.r_[code, np.frombuffer(b"abcdefgy"[::-1], np.uint64), np.frombuffer(b"qbcdefgy"[::-1], np.uint64)]
    tree = suffix_tree.SuffixTree()
    tree.grow(code, np.array([10, 10**9, 1, 10**6]), range(suffix_tree.DEPTH + 1))
    assert suffix_tree.DEPTH == 7 and code[0] >> np.uint64(8) in tree.contexts[7] and code[0] in tree.grams[7]
    assert tree.probability(code[:1])[0] > 0.5


# surrogates ----------------------------------------------------------------------------------

PERSONAL = (
    "Mail Anna.Bell42@mail.example.org or call +49 (030) 555-0199, IP 10.1.2.3 and 93.184.216.34, card 4111 1111 1111 1111, "
    "SSN 078-05-1120, IBAN DE89370400440532013000, token = \"0123456789abcdef0123456789abcdef\". "
    "Maria Petrova wrote to Mr. Okafor; Petrova and Okafor met Анна Петрова."
)


def test_surrogates_keep_type_format_script_and_gender():
    new, found = surrogates._replaced(PERSONAL, "k", {})
    kinds = Counter(e["type"] for e in found)
    assert kinds == {"mailbox": 1, "domain": 1, "phone": 1, "ip": 2, "card": 1, "ssn": 1, "iban": 1, "secret": 1, "given": 2, "family": 5}
    by_kind = {e["type"]: e["surrogate"] for e in found}
    assert re.fullmatch(r"\+49 \(\d{3}\) \d{3}-\d{4}", by_kind["phone"]) and re.fullmatch(r"\d{4}( \d{4}){3}", by_kind["card"])
    assert surrogates._luhn(by_kind["card"].replace(" ", "")) and re.fullmatch(r"[0-9a-f]{32}", by_kind["secret"])
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{3}\d{2}", by_kind["mailbox"]) and by_kind["iban"].startswith("DE")
    addresses = [e["surrogate"] for e in found if e["type"] == "ip"]
    assert addresses[0].startswith("10.") and addresses[1] != "93.184.216.34"
    given = [e["surrogate"] for e in found if e["type"] == "given"]
    assert given[0] in surrogates.GIVEN_NAMES["latin", "f"].split() and given[1] in surrogates.GIVEN_NAMES["cyrillic", "f"].split()
    families = [e["surrogate"] for e in found if e["type"] == "family"]
    assert len(set(families[:4])) == 2 and families[0] == families[2] and re.fullmatch("[А-Я][а-я]+", families[4])
    assert not any(PERSONAL[e["first"] : e["last"]] in new for e in found)


@pytest.mark.parametrize("kind, shape", [("ssn", "{:03d}"), ("card", "{:03d}"), ("family", "Ab{:c}"), ("phone", "{:03d}")])
def test_surrogates_of_a_shape_are_a_bijection(kind, shape):
    letters = "bcdfghjklmnpqrstvwxyz" if kind == "family" else ""
    known = [shape.format(ord(c)) for c in letters] or [shape.format(i) for i in range(1000)]
    for attempt in (0, 1):
        assert len({surrogates.surrogate(kind, k, "key", attempt) for k in known}) == len(known)
    assert [surrogates.surrogate(kind, k, "key") for k in known] != [surrogates.surrogate(kind, k, "other") for k in known]


def test_no_surrogate_is_an_entity_that_occurs(spark):
    """Half of a small number space is in use, so first surrogates collide all the time."""
    rows = [(i, f"card {1000000000000 + i * 9 % 90:013d} or a{i % 26}@x{i % 7}.org") for i in range(40)]
    rows += [(100, "only +1 (212) 555-0100"), (101, "a clean text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = surrogates.replace_personal_data(df).collect()
    olds, news = {}, {}
    for r, (_, text) in zip(sorted(found, key=lambda r: r.doc_id), rows, strict=True):
        for e in r.entities:
            old = text[e["first"] : e["last"]]
            assert olds.setdefault((e["type"], old), e["surrogate"]) == e["surrogate"] or e["type"] == "mailbox"
            news.setdefault((e["type"], e["surrogate"]), set()).add(old)
    assert all(len(v) == 1 for (kind, _), v in news.items() if kind != "mailbox")
    assert not {k for k in news if k[0] != "mailbox"} & set(olds)
    assert [r.text for r in found if r.doc_id == 101] == ["a clean text"]


def test_collisions_go_on_until_none_is_left(spark):
    """Of 210 domains of one shape 100 are in use, of ten 8, of another ten all; 'é' has no other text."""
    names = {f"{c}{d}" for c in "bcdfghjklm" for d in range(10)}
    crowded, full = {str(d) for d in range(8)}, {f"{d}--" for d in range(10)}
    text = " ".join(f"a@{n}.org" for n in sorted(names | crowded | full)) + " Mr Óé"
    later = surrogates.later_surrogates(spark.createDataFrame([(text,)], "text string"), "key").collect()
    attempts = {(r.type, r.canon): r.attempt for r in later}
    new = {n: surrogates.surrogate("domain", n, "key", attempts.get(("domain", n), 0)) for n in names | crowded | full}
    assert len(set(new.values())) == len(new)
    assert not names & {new[n] for n in names}
    assert {"8", "9"} <= {new[n] for n in crowded} and not any(n == new[n] for n in crowded)
    assert {new[n] for n in full} == full
    assert max(attempts.values()) > surrogates.ROUNDS


@pytest.mark.parametrize("key", [f"key {i}" for i in range(10)])
def test_every_given_name_is_replaced(key):
    for names, group in {tuple(n): g for n, g in surrogates._NAMES.values()}.items():
        for attempt in (0, 1, 7):
            new = [surrogates.surrogate("given", name, key, attempt) for name in names]
            assert sorted(new) == sorted(names), group
            assert all(a != b for a, b in zip(names, new, strict=True))


def test_the_whole_key_counts():
    long = "k" * 64
    new = {surrogates.surrogate("family", "Smithson", long + end) for end in ("", "a", "b")}
    assert len(new) == 3


def test_collision_rounds_equal_a_plain_loop(spark):
    """Three-letter families of which many are surrogates of each other."""
    names = ["Bab", "Beb", "Cac", "Dod", "Fif", "Gug", "Hah", "Jej", "Kok", "Lal", "Mim", "Non", "Pup", "Qaq", "Rer"]
    names += [a + b + c for a in "BCD" for b in "aeiou" for c in "fghjk"]
    names = sorted(set(names))
    docs = spark.createDataFrame([(i, f"Mr {n} came.") for i, n in enumerate(names)], "doc_id bigint, text string")
    found = {r.canon: r.attempt for r in surrogates.later_surrogates(docs, "plain").collect() if r.type == "family"}
    waiting, settled, attempt = set(names), {}, 0
    while waiting and attempt < surrogates.ROUNDS:
        wanted = {}
        for name in sorted(waiting):
            new = surrogates.surrogate("family", name, "plain", attempt)
            if new not in names and new not in settled.values() and new not in wanted:
                wanted[new] = name
        for new, name in wanted.items():
            settled[name] = new
            if attempt:
                assert found[name] == attempt
            else:
                assert name not in found
        waiting -= set(wanted.values())
        attempt += 1
    assert not waiting


def test_accented_letters_and_plain_phone_numbers():
    assert surrogates.surrogate("family", "Éé", "k") != "Éé"
    found = surrogates.entities("call 555-123-4567 or (555) 123-4567, not 5555-123-4567")
    assert [e[2] for e in found] == ["phone", "phone"]


@pytest.mark.parametrize(
    "kind, canon, size",
    [("domain", "b1", 210), ("ssn", "123456789", 10**9), ("ip", "192.168.1.2", 2**16), ("mailbox", "a1@b.org", 50), ("card", "4111111111111111", 10**15), ("phone", "490305550199", 10**10), ("iban", "DE89", 100), ("family", "Óé", 24 * 24), ("family", "Ææ", 1)],
)
def test_rooms_of_surrogates(kind, canon, size):
    assert surrogates._room(kind, canon)[1] == size
    for attempt in range(5):
        new = surrogates._owner_form(kind, canon, surrogates.surrogate(kind, canon, "key", attempt))
        assert surrogates._room(kind, new) == surrogates._room(kind, canon)


def test_many_collisions_are_joined_instead_of_sent(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"net 192.168.0.{i} and 192.168.0.{i + 1}") for i in range(20)], "doc_id bigint, text string")
    later = spark.createDataFrame([("ip", "192.168.0.3", 2)], "type string, canon string, attempt int")
    monkeypatch.setattr(surrogates, "later_surrogates", lambda *_: later)
    sent = sorted(map(tuple, surrogates.replace_personal_data(df).select("doc_id", "text").collect()))
    monkeypatch.setattr(surrogates, "BROADCAST_ENTITIES", 0)
    joined = sorted(map(tuple, surrogates.replace_personal_data(df).select("doc_id", "text").collect()))
    assert sent == joined and surrogates.surrogate("ip", "192.168.0.3", surrogates.KEY, 2) in sent[3][1]


def test_surrogates_of_awkward_rows(spark):
    df = awkward(spark, "entities canon")
    found = surrogates.replace_personal_data(df)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "canon", "entities"]
    assert Counter(map(tuple, found.drop("entities").collect())) == Counter(map(tuple, df.drop("entities").collect()))
    assert surrogates.replace_personal_data(empty(spark)).count() == 0


# licenses ------------------------------------------------------------------------------------


def test_licenses_are_found_in_place(spark):
    filler = " ".join(random.Random(2).choices(["alpha", "beta", "gamma", "delta"], k=400))
    rows, expected = [], {}
    for i, (name, own) in enumerate(sorted(licenses.TEMPLATES.items())):
        for j, text in enumerate(own):
            shouted = "!! ".join(text.upper().split())
            rows.append((10 * i + j, f"{filler}\n{shouted} {filler}"))
            expected[10 * i + j] = name
    rows.append((999, filler))
    found = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[999].licenses == [] and found[999].matches == []
    texts = dict(rows)
    for i, name in expected.items():
        assert name in found[i].licenses
        match = next(m for m in found[i].matches if m["license"] == name)
        place = texts[i][match["first"] : match["last"]]
        assert filler[-20:] not in place and len(place) > 15 and match["contained"] >= 0.8


def test_half_a_license_is_none(spark):
    half = licenses.TEMPLATES["MIT"][1][:90]
    df = spark.createDataFrame([(1, half), (2, f"é {licenses.TEMPLATES['MIT'][1]} ü")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert found[1].licenses == [] and found[2].licenses == ["MIT"] and found[2].matches[0]["first"] == 2


def test_license_lines_of_the_documents_are_found(spark):
    """The wordings are those that a plain search for license lines finds in the test tables."""
    names = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General Public License, version 3": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    expected = {}
    for r in docs.collect():
        lines = re.findall(r"[^.\n]*licen[sc]e[^\n]*", r.text or "", re.IGNORECASE)
        expected[r.doc_id] = sorted({name for line in lines for wording, name in names.items() if wording in line})
        assert not lines or expected[r.doc_id], lines
    assert sum("MIT" in own for own in expected.values()) > 0
    assert {r.doc_id: r.licenses for r in licenses.scan_licenses(docs).collect()} == expected


@pytest.mark.parametrize(
    "line, names",
    [
        ("Released under the MIT License.", ["MIT"]),
        ("This project is licensed under the MIT License - see LICENSE", ["MIT"]),
        ("// SPDX-License-Identifier: MIT", ["MIT"]),
        ("# SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0"]),
        ("SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]),
        ("distributed under the BSD 3-Clause License", ["BSD"]),
        ("is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["CC-BY-SA-4.0"]),
        ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
        ("The MIT lab released the software under the terms agreed", []),
    ],
)
def test_usual_one_line_notices(spark, line, names):
    rows = [(1, line), (2, f"é some words before it\n{line}\nand some more words after it"), (3, f"{line} {line}")]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [r.licenses for r in sorted(found, key=lambda r: r.doc_id)] == [names] * 3


def test_short_notices_do_not_reach_into_the_next_text(spark):
    rows = [(1, "Released under the MIT"), (2, "License."), (3, "Released under the MIT License.")]
    found = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()}
    assert found[1].licenses == [] and found[2].licenses == [] and len(found[3].matches) == 1
    assert tuple(found[3].matches[0]) == ("MIT", 0, 30, 1.0)


def test_licenses_of_awkward_rows(spark):
    df = awkward(spark, "licenses matches")
    found = licenses.scan_licenses(df).collect()
    assert len(found) == df.count() and not any(r.licenses for r in found)
    assert licenses.scan_licenses(empty(spark)).count() == 0


# top-k ---------------------------------------------------------------------------------------


def _best(known, k):
    out = set()
    for q, x in known:
        if q % 50 == 0:
            rest = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in known if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(rest)}
    return out


@pytest.mark.parametrize("many", [3, 700])
def test_top_k_equals_brute_force(spark, many, monkeypatch):
    import tablesync.llm.metric_tree as tree

    monkeypatch.setattr(tree, "GROUP", 90)
    monkeypatch.setattr(tree, "PAGE", 16)
    monkeypatch.setattr(tree, "BLOCK", 5)
    pick = random.Random(11)
    hot = [pick.randrange(-300, 300) for _ in range(6)]
    known = [(i, hot if i % 3 == 1 else [pick.randrange(-300, 300) for _ in range(6)]) for i in range(many)]
    df = spark.createDataFrame(known, "vec_id bigint, x array<bigint>")
    assert {tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0).collect()} == _best(known, 5)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [-0.001, 2.0]), (6, []), (None, [1.0, 1.0]), (50, [3.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("x", F.lit("clash"))
    found = integer_vectors(df)
    assert {r.vec_id: r.x for r in found.collect()} == {0: [256, 128], 5: [-1, 512], 6: [], 50: [768, 256, 512]}
    best = sorted(tuple(r) for r in top_k(found, F.col("vec_id") % 50 == 0).collect())
    assert best[0] == (0, 1, 50, 256 * 768 + 128 * 256) and len(best) == 6
    assert top_k(found.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# languages -----------------------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    pieces = [b" a", b"a", b"b", b"ab", b" ", b" ab"]
    keys = np.array(sorted(int(_key(p)) for p in pieces), np.uint64)
    chance = {p: (i + 1) / 30 for i, p in enumerate(pieces)}
    table = np.zeros((len(pieces) + 1, 1))
    for p, c in chance.items():
        table[np.searchsorted(keys, _key(p)), 0] = c

    def total(text):
        return 1.0 if not text else sum(chance.get(text[:n], 0) * total(text[n:]) for n in range(1, len(text) + 1))

    data = np.frombuffer(b"abba", np.uint8)
    lattice = langid.Lattice(data, np.array([0]), 4, keys, 3)
    assert math.isclose(lattice.forward(table)[-1][0, 0], total(b" abba"), rel_tol=1e-12)
    counts = lattice.expected(table, np.array([[2.0]]))
    length = {int(_key(p)): len(p) for p in pieces}
    assert math.isclose(sum(counts[i, 0] * length[int(k)] for i, k in enumerate(keys)), 2 * 5, rel_tol=1e-12)


def _key(piece):
    code = np.zeros(1, np.uint64)
    for byte in piece:
        code = langid._chain(np.array([byte], np.uint8), code)
    return code[0]


def _random_pieces(seed):
    pick = random.Random(seed)
    spelled = [bytes([b]) for b in b" abc"] + ["".join(pick.choices("abc", k=n)).encode() for n in (2, 3, 5, 8, 11) for _ in range(4)]
    spelled = sorted({*spelled, b" a", b" bca", b" abcabcabcabc"}, key=_key)
    table = np.array([[pick.random() ** 4 * 1e-3 for _ in range(2)] for _ in spelled] + [[0, 0]])
    keys = np.array([_key(p) for p in spelled], np.uint64)
    pieces = langid.Pieces(keys, ["x", "y"], 13, table, np.zeros(2))
    return pieces, dict(zip(spelled, table, strict=False)), pick


def _log_sum(text, chance):
    """The logarithm of the sum over all segmentations, in exact fractions."""
    sums = [Fraction(1)]
    for end in range(1, len(text) + 1):
        sums.append(sum(sums[begin] * Fraction(chance[text[begin:end]]) for begin in range(max(0, end - 13), end) if text[begin:end] in chance))
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


@pytest.mark.parametrize("size", [1, 20, 48, 49, 200])
def test_words_of_any_length_are_summed_whole(size):
    pieces, chance, pick = _random_pieces(size)
    word = "".join(pick.choices("abc", k=size)).encode()
    data = np.frombuffer(word, np.uint8)
    logs = langid.log_likelihoods(data, np.array([0]), np.array([size]), pieces)
    expected = [_log_sum(b" " + word, {p: c[i] for p, c in chance.items()}) for i in range(2)]
    assert np.allclose(logs[0], expected, rtol=1e-9)
    assert size < 200 or expected[0] < math.log(5e-324)  # below any floating-point number
    weight = np.array([[2.0, 3.0]])
    counts = langid.expected_counts(data, np.array([0]), np.array([size]), weight, pieces)
    alone = langid.LongWord(word, pieces.keys, pieces.longest).expected(langid._logs(pieces.chance), weight[0])
    assert np.allclose(counts, alone, rtol=1e-8)
    lengths = np.array([len(p) for p in chance])
    assert np.allclose((counts[:-1] * lengths[:, None]).sum(axis=0), weight[0] * (size + 1))


def test_predictions_equal_plain_ones(spark, table):
    """Posteriors of whole texts from the learned table, word by word in plain Python."""
    docs = table("documents").where("doc_id < 40")
    train = table("documents").where("lang is not null and text is not null and doc_id % 4 = 1")
    model = langid.learn(train.select("doc_id", "text", "lang"), str(public_tokenizers.path(langid.VOCABULARY)))
    rows = langid.identify(docs.select("doc_id", "text"), model).collect()
    place = {int(k): i for i, k in enumerate(model.keys)}
    for row in rows[:12]:
        lowered = re.sub(r"[^\w]|[\d_]", " ", (row.text or "").lower())
        total = np.zeros(len(model.languages))
        found = lowered.split()
        if len(found) > 300 or not all(c.isascii() for c in lowered):
            continue
        for word in found:
            spelled = b" " + word.encode()
            sums = [np.ones(len(model.languages))]
            for end in range(1, len(spelled) + 1):
                numbers = [(b, place.get(int(_key(spelled[b:end])))) for b in range(max(0, end - model.longest), end)]
                sums.append(sum(sums[b] * model.chance[n] for b, n in numbers if n is not None))
            total += np.log(sums[-1])
        if not found:
            assert row.lang_pred == "und"
            continue
        total = total / math.sqrt(len(found)) + model.prior
        odds = np.exp(total - total.max())
        assert row.lang_pred == model.languages[int(total.argmax())]
        assert math.isclose(row.score, odds.max() / odds.sum(), rel_tol=1e-6)


def test_all_usable_pieces_are_known():
    keys, longest = langid.vocabulary_keys(str(public_tokenizers.path(langid.VOCABULARY)))
    for piece in (" everything", " government", " a", "a", "ing"):
        assert _key(piece.encode()) in keys and len(piece) <= longest


def test_held_out_languages(spark, table):
    docs = table("documents")
    found = langid.predict_languages(docs).where("held_out and lang is not null")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    assert found.where("score < 0 or score > 1").count() == 0


def test_labels_are_not_inputs_of_a_prediction(spark, table):
    docs = table("documents").select("doc_id", "text", "lang")
    shifted = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    first, second = (
        {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.predict_languages(d, carry=["doc_id"]).collect()}
        for d in (docs, shifted)
    )
    assert first == second


def test_languages_of_awkward_rows(spark):
    df = awkward(spark, "score lang_pred a.b")
    found = langid.predict_languages(df)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "held_out", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == df.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")  # combining marks are no letters
        assert (r.lang_pred != "und") == lettered and 0 <= r.score <= 1 and (lettered or r.score == 0)
    assert langid.predict_languages(empty(spark)).count() == 0
    unlabelled = langid.predict_languages(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


# the pipeline --------------------------------------------------------------------------------


def test_pipeline_stages_by_brute_force(spark, table):
    """Each stage on its own input against what its rule says."""
    docs = table("documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "exact dedup", "MinHash near-dedup", "mixing", "best-fit packing"]
    kept = stages["language ID"](spark, docs, DATA).cache()
    assert kept.columns == corpus_pipeline.COLUMNS and kept.count() == docs.count()
    exact = stages["exact dedup"](spark, kept, DATA).cache()
    best = {}
    for r in kept.collect():
        key = " ".join(map(str, [len(words(r.text)), r.text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))]))
        best[key] = max(best.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(best.values())
    near = stages["MinHash near-dedup"](spark, exact, DATA)
    from test_text_operators import _similar

    roots = _similar({r.doc_id: r.text for r in exact.collect()}, 5, 80)
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, (_, root) in roots.items() if i == root)
    mixed = stages["mixing"](spark, near, DATA)
    assert mixed.columns == corpus_pipeline.COLUMNS
    packed = stages["best-fit packing"](spark, mixed, DATA)
    counts = Counter(r.doc_id for r in packed.where("piece = 0").collect())
    assert counts == Counter(r.doc_id for r in mixed.collect())
    near.unpersist(), exact.unpersist(), kept.unpersist()


def test_pipeline_of_awkward_rows(spark):
    docs = awkward(spark, "other")
    for name, apply in corpus_pipeline.STAGES:
        after = apply(spark, docs, DATA)
        if name != "best-fit packing":
            assert after.columns == corpus_pipeline.COLUMNS
            assert apply(spark, empty(spark), DATA).count() == 0
            docs = after
    assert after.count() > 0
