"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Entities are e-mail addresses, phone numbers, payment card numbers, IPv4 addresses, US social security numbers, IBANs
and names after a title. Each distinct entity of the corpus (its type and normal form, so that one number in two
spellings is one entity) gets one surrogate, drawn from an HMAC of the entity under the caller's key, and every
mention of it gets that surrogate in the mention's own spelling: mentions that referred to one thing still do. Given
names and surnames are entities of their own, so that a surname keeps its surrogate with and without a given name.
A name that stands behind a title anywhere in a text is looked for in all of it, as a whole word that starts with a
capital; the initials between title and surname stay.

Distinct entities must keep apart, so each round of assignment checks all draws of the corpus against each other,
against those settled before and against the originals; the entity with the smallest normal form keeps a contested
surrogate, and the others draw again. Later draws of names and addresses grow longer, so rounds come to an end.

A null text stays null, a text without entities stays as it is. Rows are told apart by id and text, so null and
repeated ids do no harm.
"""

import bisect
import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.frames import kept
from gleanery.llm.groups import packed, sliced, unpacked

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
#: No digit, nor one behind a mark, may go on at either side of a number.
BEFORE, AFTER = r"(?<![\d+])(?<!\d[.-])", r"(?!\d)(?![.-]\d)"
CARD = rf"{BEFORE}(?:\d{{13,19}}|\d{{4}}([ -])\d{{4}}\1\d{{4}}\1\d{{1,7}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}}){AFTER}"
GROUPS = r"\d{1,4}(?:[ .-]?\d{1,4}){1,6}"
DATE = r"0\d[ ./-][01]\d[ ./-](?:19|20)\d\d(?!\d)"
#: International numbers behind + or 00; North American ones; those with a trunk 0; Spanish ones.
PHONE = "|".join([
    rf"(?<![\d+])\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?{GROUPS}(?!\d)",
    rf"{BEFORE}00 ?[1-9]\d{{0,2}}(?:[ .-]|[ .-]?\(\d{{1,4}}\)[ .-]?){GROUPS}{AFTER}",
    rf"{BEFORE}(?:1[ .-]?)?(?:\(\d{{3}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}{AFTER}",
    rf"{BEFORE}1?[2-9]\d{{2}}[2-9]\d{{6}}{AFTER}",
    rf"{BEFORE}(?!{DATE})(?:\(0[1-9]\d{{0,4}}\)(?: ?[/-] ?|[ .])?|0[1-9]\d{{0,4}}(?: ?[/-] ?|[ .]))\d{{2,8}}(?:[ .-]\d{{2,4}}){{0,4}}{AFTER}",
    rf"{BEFORE}0[1-9]\d{{8,9}}{AFTER}",
    rf"{BEFORE}(?:[6-9]\d{{2}}[ .-]\d{{2}}|9\d[ .-]\d{{3}})[ .-]\d{{2}}[ .-]\d{{2}}{AFTER}",
])
SSN = rf"{BEFORE}\d{{3}}-\d{{2}}-\d{{4}}{AFTER}"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d])(?!\.\d)"
FEMALE = "Mrs Ms Miss Frau Mme Madame Sra Señora Signora г-жа Госпожа κυρία".split()
MALE = "Mr Herr M Monsieur Sr Señor Signor г-н Господин κύριος".split()
NEUTRAL = "Dr Prof".split()
LETTERS = r"[^\W\d_]+"
NAME = rf"{LETTERS}(?:[-'’]{LETTERS})*"
#: Titles that are words or abbreviations of others count only with their dot.
DOTTED = ("M", "Sr", "Sra")
PARTICLES = "von van de der den del della di da dos du la le zu zum zur y bin ibn al el ten ter".split()
TITLE = "|".join([rf"(?:{'|'.join(DOTTED)})\.", rf"(?:{'|'.join(t for t in FEMALE + MALE + NEUTRAL if t not in DOTTED)})\.?"])
TITLED = re.compile(rf"(?<!\w)((?:(?:{TITLE})\s+)+)({NAME})")
#: What ends a name, or stands before the next one.
NO_NAME = {*FEMALE, *MALE, *NEUTRAL, "Jr"} - {"M"}
#: What may follow a part of a name: an initial's dot, particles, and the next part in the same line.
NEXT = re.compile(rf"(?:\.[^\S\r\n]*|[^\S\r\n]+)(?:(?:{'|'.join(PARTICLES)})[^\S\r\n]+)*({NAME})")
WORD = re.compile(rf"(?<!\w){NAME}(?!\w)")
#: Patterns in order of precedence: a later one gives way where it overlaps an earlier one.
PATTERNS = [
    ("email", re.compile(EMAIL)),
    ("iban", re.compile(IBAN)),
    ("ssn", re.compile(SSN)),
    ("card", re.compile(CARD)),
    ("phone", re.compile(PHONE)),
    ("ip", re.compile(IP)),
]
HINT = re.compile(r"[0-9@]")

#: Syllables by script; names are built from them by rule.
SYLLABLES = {
    "LATIN": (["ba", "be", "da", "do", "el", "fa", "ga", "ha", "ka", "la", "le", "ma", "mi", "na", "no", "ra", "ri",
               "sa", "so", "ta", "ti", "va", "vi", "zo"], "a", "n"),
    "CYRILLIC": (["ба", "ве", "га", "да", "ди", "за", "ка", "ко", "ла", "ле", "ма", "ми", "на", "но", "ра", "ри",
                  "са", "со", "та", "ти"], "а", "н"),
    "GREEK": (["βα", "γα", "δα", "δη", "κα", "κο", "λα", "λε", "μα", "μι", "να", "νο", "ρα", "ρι", "σα", "σο", "τα",
               "τι"], "α", "ς"),
}


def luhn(digits: str) -> int:
    """0 for a valid card number; else what its check digit is off by."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


def iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def iban_valid(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def fitting(value: str, start: int, taken: list[tuple[int, int]]) -> str:
    """A number without its last groups where it would run into another entity or have more than 15 digits."""
    end = min((a for a, _ in taken if a > start), default=start + len(value)) - start
    while len(value) > end or sum(c.isdigit() for c in value) > 15:
        shorter = re.sub(r"[^\d]+\d*$", "", value[:-1])
        if shorter == value[:-1]:
            break
        value = shorter
    return value


def dialled(value: str, digits: str) -> str:
    """A phone number with its country's code, where it is given or it is a North American number."""
    if value[0] == "+":
        return "+" + digits
    if digits.startswith("00"):
        return "+" + digits[2:]
    if len(digits) == 11 and digits[0] == "1":
        return "+" + digits
    return "+1" + digits if len(digits) == 10 and digits[0] != "0" else digits


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text: (start, end, type, normal form), in order and without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for kind, pattern in PATTERNS if HINT.search(text) else []:
        for m in pattern.finditer(text):
            value, span = m.group(), m.span()
            if kind == "phone":
                value = fitting(value, span[0], taken)
                span = (span[0], span[0] + len(value))
            if any(a < span[1] and span[0] < b for a, b in taken):
                continue
            digits = re.sub(r"\D", "", value)
            if kind == "iban" and not iban_valid(value.replace(" ", "")):
                continue
            if kind == "phone" and not 7 <= len(digits) <= 15:
                continue
            normal = {"email": value.lower(), "iban": value.replace(" ", ""), "ip": value}.get(kind, digits)
            if kind == "phone":
                normal = dialled(value, digits)
            taken.append(span)
            found.append((*span, kind, normal))
    return sorted(found + names(text, sorted(taken)))


def name_parts(text: str, first: re.Match) -> list[tuple[int, int]]:
    """Spans of the parts of a titled name, without initials unless there is nothing else."""
    spans, m, group = [], first, 2
    while m and m[group][0].isupper() and m[group] not in NO_NAME:
        a, b = m.span(group)
        if text[a:b].endswith(("'s", "’s")):
            spans.append((a, b - 2))
            break
        spans.append((a, b))
        m, group = NEXT.match(text, b), 1
        if m and text[b] == "." and b - a > 1:
            break
    return [(a, b) for a, b in spans if b - a > 1] or spans[-1:]


def names(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """Titled names, and every other mention of them in the text; `taken` are the spans of other entities, in order."""
    found: dict[tuple[int, int], str] = {}
    alone, known, genders = [], {}, {}
    for m in TITLED.finditer(text):
        titles = [t.rstrip(".") for t in m[1].split()]
        gender = next(("f" if t in FEMALE else "m" for t in titles if t not in NEUTRAL), "x")
        parts = name_parts(text, m)
        if len(parts) == 1:
            alone += parts
        for i, (a, b) in enumerate(parts if len(parts) > 1 else []):
            normal = text[a:b].casefold()
            found[a, b] = "surname" if i else "given"
            known.setdefault(normal, found[a, b])
            if not i and genders.get(normal, "x") == "x":
                genders[normal] = gender
    for a, b in alone:
        found[a, b] = known.setdefault(text[a:b].casefold(), "surname")
    if not known:
        return []
    found = {span: kind for span, kind in found.items() if not overlaps(taken, *span)}
    longest = max(len(re.split("[-'’]", n)) for n in known)
    spans = sorted([*taken, *found])
    for m in WORD.finditer(text):
        pieces = [(m.start() + p.start(), m.start() + p.end()) for p in re.finditer(LETTERS, m.group())]
        i = 0
        while i < len(pieces):
            for j in range(min(len(pieces), i + longest), i, -1):
                a, b = pieces[i][0], pieces[j - 1][1]
                kind = known.get(text[a:b].casefold()) if text[a].isupper() else None
                if kind and not overlaps(spans, a, b):
                    found[a, b] = kind
                    break
            else:
                j = i + 1
            i = j
    entities = []
    for (a, b), kind in found.items():
        normal = text[a:b].casefold()
        entities.append((a, b, f"given_{genders[normal]}" if kind == "given" else kind, normal))
    return entities


def overlaps(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether any of the spans, which are in order and apart, has a part between a and b."""
    i = bisect.bisect_left(spans, (b, b))
    return i > 0 and spans[i - 1][1] > a


class Draws:
    """An endless stream of numbers from a keyed hash of an entity."""

    def __init__(self, key: bytes, kind: str, normal: str, attempt: int) -> None:
        self.key, self.seed, self.count, self.left = key, f"{kind}\0{normal}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + self.count.to_bytes(8, "big"), hashlib.sha256).digest()
            self.count += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n

    def like(self, text: str) -> str:
        """Letters for letters and digits for digits; other characters stay."""
        out = []
        for c in text:
            if c.isdigit() and c.isascii():
                out.append(str(self.below(10)))
            elif c.isascii() and c.isalpha():
                out.append(chr((97 if c.islower() else 65) + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def script_of(name: str) -> str:
    return unicodedata.name(name[0], "LATIN").split()[0]


def draw(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """The surrogate's normal form."""
    d = Draws(key, kind, normal, attempt)
    if kind == "email":
        local, domain = normal.rsplit("@", 1)
        host, _, top = domain.rpartition(".")
        host = Draws(key, "host", host, 0).like(host)
        return f"{d.like(local)}{'x' * (attempt // 8)}@{host}.{top}"
    if kind == "card":
        body = normal[0] + d.like(normal[1:])
        if luhn(normal) == 0:
            body = next(b for c in range(10) if luhn(b := body[:-1] + str(c)) == 0)
        return body
    if kind == "iban":
        body = d.like(normal[4:])
        return normal[:2] + iban_check(normal[:2], body) + body
    if kind == "ssn":
        return f"{1 + d.below(665):03d}{1 + d.below(99):02d}{1 + d.below(9999):04d}"
    if kind == "ip":
        first = normal.split(".")[0]
        head = first if first in ("10", "127", "192") else str(11 + d.below(112))
        return ".".join([head] + [str(d.below(256)) for _ in range(3)])
    if kind == "phone":
        if normal[:2] == "+1" and len(normal) == 12:
            return f"+1{2 + d.below(8)}{d.like(normal[3:5])}{2 + d.below(8)}{d.like(normal[6:])}"
        if normal[0] == "+":
            cut = 2 if normal[1] in "17" else 3
            return normal[:cut] + str(2 + d.below(8)) + d.like(normal[cut + 1 :])
        if normal[0] == "0":
            return f"0{2 + d.below(8)}{d.like(normal[2:])}"
        return normal[0] + d.like(normal[1:])
    script = script_of(normal)
    if script not in SYLLABLES:
        return "".join(chr(ord(c) + 1 + d.below(3)) if c.isalpha() else c for c in normal) + normal[-1] * (attempt // 8)
    syllables, feminine, masculine = SYLLABLES[script]
    n = max(2, min(5, (len(normal) + 1) // 2)) + attempt // 4
    stem = "".join(syllables[d.below(len(syllables))] for _ in range(n))
    return stem + {"given_f": feminine, "given_m": masculine}.get(kind, "")


def spelled(kind: str, mention: str, surrogate: str) -> str:
    """A surrogate in the spelling of the mention that it replaces."""
    if kind == "email":
        return surrogate.upper() if mention.isupper() else surrogate
    if kind in ("card", "phone", "ssn", "iban"):
        digits = surrogate.lstrip("+")
        if kind == "phone":
            digits = ("00" + digits)[-sum(c.isdigit() for c in mention) :]
        left = iter(digits)
        return "".join(next(left) if c.isalnum() else c for c in mention)
    if kind == "ip":
        return surrogate
    return surrogate.upper() if mention.isupper() and len(mention) > 1 else surrogate.capitalize()


#: Names of the hashes that identify a row by its id and text.
ROW = ["_h1", "_h2"]


def row_hashes(key: str, text: str) -> list:
    return [F.xxhash64(key, text).alias(ROW[0]), F.hash(text, key).alias(ROW[1])]


def mentions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each entity of each row: row id, place, type, normal form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows, found = [], []
            for i, body in enumerate(batch.column("_text").to_pylist()):
                for x in find(body or ""):
                    rows.append(i)
                    found.append(x)
            at = pa.array(rows, pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
            columns = [pa.array([x[j] for x in found], t) for j, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ROW), *columns], [*ROW, "start", "end", "kind", "normal"]
            )

    identified = docs.select(*row_hashes(key, text), F.col(text).alias("_text"))
    return identified.mapInArrow(run, "_h1 long, _h2 int, start int, end int, kind string, normal string")


def drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """Add each entity's draw of its attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "normal", "attempt")))
            found = pa.array([draw(key, *row) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "surrogate"])

    return entities.mapInArrow(run, "kind string, normal string, attempt int, surrogate string")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """Surrogates of distinct entities (kind, normal): all different, and none an original of its kind."""
    entities = kept(entities.select("kind", "normal").distinct())
    originals = entities.select("kind", F.col("normal").alias("surrogate"))
    settled = None
    pending = entities.withColumn("attempt", F.lit(0))
    while True:
        draws = kept(drawn(pending, key))
        first = draws.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal"))
        free = first.join(originals, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        won = free.select("kind", "normal", "surrogate")
        settled = kept(won if settled is None else settled.unionByName(won))
        lost = draws.join(settled, ["kind", "normal"], "left_anti")
        pending = kept(lost.select("kind", "normal", (F.col("attempt") + 1).alias("attempt")))
        if pending.isEmpty():
            return settled


def replaced(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with surrogates in its texts, and n_entities, the number of mentions replaced.

    Texts are compressed for the one shuffle that brings them together with their surrogates.
    """
    docs = docs.drop("n_entities")
    found = kept(mentions(docs, key, text))
    surrogates = assign(found, secret)
    span = F.struct("start", "end", "kind", "surrogate")
    spans = (
        found.dropDuplicates([*ROW, "start"])
        .join(surrogates, ["kind", "normal"])
        .groupBy(*ROW)
        .agg(F.array_sort(F.collect_list(span)).alias("_spans"))
    )
    names = docs.columns
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == text else f for f in docs.schema]
    held = [*fields, T.StructField("_null", T.BooleanType())]
    held += [T.StructField(ROW[0], T.LongType()), T.StructField(ROW[1], T.IntegerType())]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [packed(batch, c) if c == text else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("_null", "_spans")))
            texts, counts = unpacked(batch.column(text)).to_pylist(), []
            for i, (null, places) in enumerate(rows):
                texts[i] = None if null else rewritten(texts[i], places or [])
                counts.append(len(places or []))
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*names, "n_entities"])

    hashed = docs.select("*", F.col(text).isNull().alias("_null"), *row_hashes(key, text))
    joined = hashed.mapInArrow(pack, T.StructType(held)).join(spans, ROW, "left").drop(*ROW)
    return joined.mapInArrow(run, T.StructType([*docs.schema, T.StructField("n_entities", T.LongType())]))


def rewritten(text: str, places: list[dict]) -> str:
    parts, at = [], 0
    for s in places:
        parts += [text[at : s["start"]], spelled(s["kind"], text[s["start"] : s["end"]], s["surrogate"])]
        at = s["end"]
    return "".join([*parts, text[at:]])
