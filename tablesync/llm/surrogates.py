"""Personal data replaced by surrogates of the same type, format, script and gender.

A surrogate is the image of the entity under a keyed permutation of all texts of its shape
(vowels, consonants and digits place by place; names among names of their gender and script),
so one entity has one surrogate in the whole corpus and two entities never share one. What the
permutation can't know is checked over the whole corpus: no surrogate may be an entity that
occurs. Entities found in such a collision are permuted again until none is left. Only where a
shape has fewer free texts than entities, the last ones take texts that occur, each another one.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablesync.llm.common import map_arrow, quoted
from tablesync.sinks.files import stage

KEY = "surrogate key"
#: Rounds with one more attempt; then what still collides takes twice as many in each round, and
#: shapes without free texts are looked for.
ROUNDS = 8
#: Attempts of all entities in one of the later rounds, about.
ATTEMPTS = 1_000_000
#: Entities with a later surrogate that are sent to all tasks; more are joined to their texts.
BROADCAST_ENTITIES = 100_000

# Given names by script and gender, and forms of address by gender.
GIVEN_NAMES = {
    ("latin", "f"): "Alice Barbara Carolina Charlotte Daniela Diana Elizabeth Emily Fatima Francesca Gabriela Hannah Ingrid Isabella Jennifer Jessica Julia Katharina Laura Linda Lucia Margaret Maria Monika Natalia Olivia Patricia Priya Rachel Rebecca Sabine Sarah Sofia Susan Teresa Ursula Valentina Victoria Yasmin Zoe",
    ("latin", "m"): "Ahmed Alexander Andreas Benjamin Carlos Charles Christopher Daniel David Diego Edward Fernando Francisco George Hans Henry Ivan James Javier Jean John Joseph Karl Louis Manuel Matthew Michael Miguel Mohammed Nicholas Oliver Pablo Patrick Paul Peter Richard Robert Stefan Thomas William",
    ("cyrillic", "f"): "Анна Виктория Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    ("cyrillic", "m"): "Александр Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Олег Павел Сергей",
    ("greek", "f"): "Αικατερίνη Βασιλική Γεωργία Ελένη Μαρία Σοφία",
    ("greek", "m"): "Αλέξανδρος Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Νικόλαος",
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Señor": "m", "Señora": "f", "Dr": "", "Prof": ""}
# Vowels and consonants of the scripts whose letters are replaced.
ALPHABETS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "0123456789", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αειουω", "βγδζθκλμνξπρστφχψ", "àáâäãåèéêëìíîïòóôöõøùúûü", "çčćďľłńñřšśťýžźż", "ёіїє", "άέήίόύώ"]

_CLASS = {c: a for a in ALPHABETS for c in a} | {c.upper(): a.upper() for a in ALPHABETS for c in a}
_NAMES = {name: (names.split(), group) for group, names in GIVEN_NAMES.items() for name in names.split()}
_CAPITAL = r"[^\W\d_][^\W\d_]*(?:[-'’][^\W\d_]+)*"
_TITLE = "|".join(TITLES)
_GIVEN = "|".join(sorted(_NAMES, key=len, reverse=True))

#: Types in the order in which they are looked for; a later type does not reach into an earlier.
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])", re.ASCII),
    "secret": re.compile(r"""(?i:\b(?:token|secret|password|api[_-]?key|access[_-]?key)\b["']?\s*[:=]\s*["']?)([A-Za-z0-9+/_=-]{16,})"""),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)", re.ASCII),
    "phone": re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w(.+-])\d{3}([.-])\d{3}\1\d{4}(?![\w-])", re.ASCII),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII),
    "card": re.compile(r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])", re.ASCII),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?!\w)", re.ASCII),
    "person": re.compile(rf"(?<!\w)(?:(?P<title>{_TITLE})\.?[ ])?(?P<given>{_GIVEN})(?: (?P<family>{_CAPITAL}))?(?!\w)|(?<!\w)(?P<title2>{_TITLE})\.? (?P<family2>{_CAPITAL})(?!\w)"),
}
_NAME = re.compile(rf"(?<!\w){_CAPITAL}(?!\w)")
#: A text without any of these has no entity.
_HINT = re.compile(rf"[@0-9]|(?i:token|secret|password|key)|(?<!\w)(?:{_GIVEN}|{_TITLE})(?!\w)")


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """First and last character, type and canonical form of each entity, in order of place.

    A canonical form tells who is meant: an address in lower case, a number without its
    separators. Given and family names are entities of their own, and a family name met once
    after a given name or a title is found wherever it stands in the text.
    """
    if not _HINT.search(text):
        return []
    found: list[tuple[int, int, str, str]] = []
    families: set[str] = set()
    for kind, pattern in PATTERNS.items():
        taken = _Spans(found)
        for match in pattern.finditer(text):
            first, last = match.span(1) if kind == "secret" else match.span()
            if taken.meet(first, last):
                continue
            if kind == "person":
                family = match["family"] or match["family2"]
                if family and family[0].isupper():
                    families.add(family)
                    if match["given"]:
                        found.append((match.start("given"), match.end("given"), "given", match["given"]))
            elif kind == "email":
                at = match.group().index("@")
                dot = match.group().rindex(".")
                found.append((first, first + at, "mailbox", match.group().lower()))
                found.append((first + at + 1, first + dot, "domain", match.group()[at + 1 : dot].lower()))
            elif kind == "secret":
                found.append((first, last, kind, match.group(1)))
            elif kind == "ip":
                found.append((first, last, kind, ".".join(str(int(p)) for p in match.group().split("."))))
            else:
                found.append((first, last, kind, "".join(c for c in match.group() if c.isalnum())))
    if families:
        taken = _Spans(found)
        for match in _NAME.finditer(text):
            name = match.group()
            if name in families and not taken.meet(*match.span()):
                found.append((*match.span(), "given" if name in _NAMES else "family", name))
    return sorted(found)


class _Spans:
    """Spans that do not overlap each other; each look-up is a binary search."""

    def __init__(self, found: list[tuple[int, int, str, str]]):
        spans = sorted(e[:2] for e in found)
        self._first, self._last = [s[0] for s in spans], [s[1] for s in spans]

    def meet(self, first: int, last: int) -> bool:
        before = bisect_left(self._first, last)
        return before > 0 and self._last[before - 1] > first


def _permute(index: int, size: int, key: bytes) -> int:
    """A keyed permutation of 0 to size - 1: a balanced Feistel network, walked until inside."""
    if size < 2:
        return index
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = index >> half, index & mask
        for turn in range(8):
            mixed = hashlib.blake2b(b"%d:%d" % (turn, right), key=key, digest_size=16).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        index = left << half | right
        if index < size:
            return index


def _shaped(text: str, key: bytes, fixed: int = 0) -> str:
    """The image of a text among all texts with the same kind of character in each place but
    the first `fixed` ones."""
    size, index = 1, 0
    places = [(i, _CLASS[c]) for i, c in enumerate(text) if c in _CLASS and i >= fixed]
    for i, alphabet in places:
        size, index = size * len(alphabet), index * len(alphabet) + alphabet.index(text[i])
    shape = "".join(_CLASS[c][0] if c in _CLASS and i >= fixed else c for i, c in enumerate(text))
    index = _permute(index, size, hashlib.blake2b(shape.encode(), key=key, digest_size=32).digest())
    out = list(text)
    for i, alphabet in reversed(places):
        index, digit = divmod(index, len(alphabet))
        out[i] = alphabet[digit]
    return "".join(out)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return total % 10 == 0


_BLOCKS = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16", "224.0.0.0/4", "0.0.0.0/8")]


def _address(text: str, key: bytes) -> str:
    """An address of the same block, or a global one for a global one."""
    number = int(ipaddress.IPv4Address(text))
    for block in _BLOCKS:
        if ipaddress.IPv4Address(number) in block:
            base = int(block.network_address)
            own = hashlib.blake2b(str(block).encode(), key=key, digest_size=32).digest()
            return str(ipaddress.IPv4Address(base + _permute(number - base, block.num_addresses, own)))
    while True:
        number = _permute(number, 1 << 32, key)
        if not any(ipaddress.IPv4Address(number) in b for b in _BLOCKS):
            return str(ipaddress.IPv4Address(number))


def surrogate(kind: str, canon: str, secret: str, attempt: int = 0) -> str:
    """The replacement of a canonical form; a bijection on each shape for a fixed attempt."""
    whole = hashlib.blake2b(secret.encode()).digest()
    key = hashlib.blake2b(f"{kind}:{attempt}".encode(), key=whole, digest_size=32).digest()
    if kind == "given":  # the next name around a keyed circle of all, so none is its own
        names, _ = _NAMES[canon]
        circle = sorted(names, key=lambda name: hashlib.blake2b(name.encode(), key=key, digest_size=16).digest())
        return circle[(circle.index(canon) + 1) % len(circle)]
    if kind == "ip":
        return _address(canon, key)
    if kind == "card":
        valid, out = _luhn(canon), _shaped(canon, key)
        while _luhn(out) != valid:  # cards stay cards, other numbers others
            out = _shaped(out, key)
        return out
    if kind == "mailbox":
        box, at, domain = canon.partition("@")
        return _shaped(box, hashlib.blake2b(domain.encode(), key=key, digest_size=32).digest())
    if kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", canon):  # hexadecimal stays so
        size = 16 ** len(canon)
        new = f"{_permute(int(canon, 16), size, key):0{len(canon)}x}"
        return new if canon == canon.lower() else new.upper()
    if kind == "phone":
        return _shaped(canon, key, fixed=max(0, len(canon) - 10))  # the country code stays
    return _shaped(canon, key, fixed=2 if kind == "iban" else 0)


def _formatted(found: str, canon: str, new: str) -> str:
    """The new canonical form with the separators and the capitals of the text it replaces."""
    if found == canon:
        return new
    fresh = iter(new)
    whole = len(found) == len(canon)
    out = [next(fresh) if whole or c.isalnum() else c for c in found]
    return "".join(n.upper() if c.isupper() else n for c, n in zip(found, out, strict=True))


def _replaced(text: str, secret: str, later: dict[tuple[str, str], int]) -> tuple[str, list[dict]]:
    out, done, at = [], [], 0
    for first, last, kind, canon in entities(text):
        if first < at:
            continue
        new = surrogate(kind, canon, secret, later.get((kind, canon), 0))
        if kind != "ip":
            new = _formatted(text[first:last], canon[: last - first] if kind == "mailbox" else canon, new)
        out += [text[at:first], new]
        done.append({"type": kind, "first": first, "last": last, "surrogate": new})
        at = last
    return "".join([*out, text[at:]]), done


def _owner_form(kind: str, canon: str, new: str) -> str:
    """A surrogate as the canonical form that it would be read as."""
    return f"{new}@{canon.partition('@')[2]}" if kind == "mailbox" else new


def _room(kind: str, canon: str) -> tuple[str, int]:
    """A name for the texts among which the surrogate is, and their number (up to 2^62)."""
    if kind == "ip":
        for block in _BLOCKS:
            if ipaddress.IPv4Address(canon) in block:
                return str(block), block.num_addresses
        return "", (1 << 32) - sum(b.num_addresses for b in _BLOCKS)
    if kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", canon):
        return f"{len(canon)} {canon == canon.lower()}", min(16 ** len(canon), 1 << 62)
    text, _, domain = canon.partition("@") if kind == "mailbox" else (canon, "", "")
    fixed = max(0, len(canon) - 10) if kind == "phone" else 2 if kind == "iban" else 0
    size = 1
    for c in text[fixed:]:
        size *= len(_CLASS.get(c, " "))
    name = text[:fixed] + "".join(_CLASS.get(c, c)[0] for c in text[fixed:]) + "@" + domain
    if kind == "card":
        return f"{name} {_luhn(canon)}", size // 10 if _luhn(canon) else size - size // 10
    return name, min(size, 1 << 62)


def later_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """type, canon and attempt of the entities of `text` whose first surrogate collides with an
    entity of the corpus, or with a surrogate chosen for another one.

    An entity takes the first attempt that is free; of several entities the one with the lowest
    attempt, then the lowest canonical form, has it. This goes on until all have one. In a shape
    whose texts all occur or are taken, what is left (`loose`) takes texts that occur but are no
    other's surrogate, itself only if nothing else is left.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = {e[2:] for t in batch.column("text").to_pylist() if t for e in entities(t)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["type", "canon"]
            )

    def claimed(width: int):
        def claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pylist()
                step = max(1, 50_000 // width)
                for at in range(0, len(rows), step):
                    tried = [r | {"attempt": r["attempt"] + i} for r in rows[at : at + step] for i in range(width)]
                    for r in tried:
                        r["new"] = _owner_form(r["type"], r["canon"], surrogate(r["type"], r["canon"], key, r["attempt"]))
                    yield pa.RecordBatch.from_pylist(tried, _CLAIM)

        return claims

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rooms = [_room(r["type"], r["canon"]) for r in batch.to_pylist()]
            name, size = pa.array([r[0] for r in rooms], pa.string()), pa.array([r[1] for r in rooms], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, name, size], ["type", "canon", "shape", "size"])

    # a list of names is too short to leave out the names that occur: they are only kept distinct
    known = map_arrow(docs.select("text"), found, "type string, canon string").filter("type <> 'given'").distinct()
    known = stage(known, "entities")
    waiting = known.select("type", "canon", F.lit(0).alias("attempt"), F.lit(False).alias("loose"), F.lit(False).alias("itself"))
    settled, shaped, width, turn = None, None, 1, 0
    while True:
        claims = "type string, canon string, attempt int, loose boolean, itself boolean, new string"
        claims = stage(map_arrow(waiting, claimed(width), claims), "surrogates")
        # inner joins with distinct texts, so that the smaller side can be sent
        taken = claims.filter("not loose").select("type", "new").distinct()
        taken = taken.join(known.withColumnRenamed("canon", "new"), ["type", "new"]).withColumn("loose", F.lit(False))
        if settled is not None:
            used = claims.select("type", "new", "loose").distinct().join(settled.select("type", "new"), ["type", "new"])
            taken = taken.unionByName(used)
        free = claims.filter("itself or new <> canon").join(stage(taken, "collisions"), ["type", "new", "loose"], "left_anti")
        first = free.groupBy("type", "new").agg(F.min(F.struct("attempt", "canon")).alias("first"))
        first = first.groupBy("type", "first.canon").agg(F.min(F.struct("first.attempt", "new")).alias("first"))
        won = stage(first.select("type", "canon", "first.attempt", "first.new"), "settled")
        settled = won if settled is None else settled.union(won)
        waiting = waiting.join(won.select("type", "canon"), ["type", "canon"], "left_anti")
        waiting = stage(waiting.withColumn("attempt", F.col("attempt") + width), "waiting")
        turn += 1
        if waiting.isEmpty():
            break
        if turn >= ROUNDS:
            shaped = shaped or stage(map_arrow(known, sized, "type string, canon string, shape string, size bigint"), "shapes")
            settled = stage(settled, "settled")
            own = shaped.join(waiting, ["type", "canon"]).select("type", "shape").distinct()
            held = shaped.join(own, ["type", "shape"]).join(settled.select("type", "canon", "new"), ["type", "canon"], "left")
            rooms = held.groupBy("type", "shape").agg(F.min("size").alias("size"), F.count("*").alias("n"), F.count("new").alias("used"))
            waiting = waiting.drop("loose", "itself").join(shaped.drop("size"), ["type", "canon"]).join(rooms, ["type", "shape"])
            full, last = F.col("size") <= F.col("n") + F.col("used"), F.col("size") - F.col("used") <= F.col("n") - F.col("used")
            waiting = waiting.select("type", "canon", "attempt", full.alias("loose"), (full & last).alias("itself"))
            waiting = stage(waiting, "waiting")
            width = max(1, min(2 * width, ATTEMPTS // waiting.count()))
    return stage(settled.filter("attempt > 0").select("type", "canon", "attempt"), "later-surrogates")


_CLAIM = pa.schema([("type", pa.string()), ("canon", pa.string()), ("attempt", pa.int32()), ("loose", pa.bool_()), ("itself", pa.bool_()), ("new", pa.string())])


def replace_personal_data(docs: DataFrame, key: str = KEY) -> DataFrame:
    """`docs` with `text` rewritten and a new column `entities` (replacing one of that name):
    type, first and last character in the text as it was, and the surrogate.

    Types: mailbox and domain of an e-mail address (its ending stays), secret, ip (of the same
    block), phone (its country code stays), ssn, card (valid check digits stay valid), iban,
    given and family names. Not looked for: a given name alone ("Henry met her"), family names after
    neither a title nor a listed given name, and addresses of houses. A given name's surrogate is another
    name of its script and gender; a family name keeps its letters' kinds, not an ending that tells
    a gender. Texts without entities, null texts among them, stay as they are.
    The same entity has the same surrogate in every row, so repeated rows stay equal. An empty
    table gives an empty table.
    """
    columns = [c for c in docs.columns if c != "entities"]
    docs = docs.select(*quoted(columns))
    later = later_surrogates(docs, key)
    few = later.count() <= BROADCAST_ENTITIES
    known: dict[tuple[str, str], int] = {}
    if few:
        known = {(r["type"], r["canon"]): r["attempt"] for r in later.collect()}
        source = docs.withColumn("_later", F.lit(None).cast(_LATER))
    else:
        numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "texts")

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, rows = batch.column("text").to_pylist(), batch.column("_row").to_pylist()
                own = {(r, *e[2:]) for r, t in zip(rows, texts, strict=True) if t for e in entities(t)}
                yield pa.RecordBatch.from_pylist([{"_row": r, "type": k, "canon": c} for r, k, c in own], pa.schema([("_row", pa.int64()), ("type", pa.string()), ("canon", pa.string())]))

        met = map_arrow(numbered.select("_row", "text"), listed, "_row bigint, type string, canon string")
        met = met.join(later, ["type", "canon"]).groupBy("_row").agg(F.collect_list(F.struct("type", "canon", "attempt")).alias("_later"))
        source = numbered.join(met, "_row", "left").drop("_row")

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = batch.column("text").to_pylist(), batch.column("_later").to_pylist()
            done = [
                (None, []) if t is None else _replaced(t, key, known if o is None else {(e["type"], e["canon"]): e["attempt"] for e in o})
                for t, o in zip(texts, own, strict=True)
            ]
            out = [pa.array([d[0] for d in done], pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*out, pa.array([d[1] for d in done], _ENTITY)], [*columns, "entities"])

    fields = [StructField("text", StringType()) if f.name == "text" else f for f in docs.schema.fields]
    described = StructType([*fields, *docs.sparkSession.createDataFrame([], _ENTITIES).schema.fields])
    return map_arrow(source.select(*quoted(columns), "_later"), rewritten, described)


_LATER = "array<struct<type:string,canon:string,attempt:int>>"
_ENTITIES = "entities array<struct<type:string,first:bigint,last:bigint,surrogate:string>>"
_ENTITY = pa.list_(pa.struct([("type", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("surrogate", pa.string())]))
