"""Keyed surrogates for personal data and secrets: same entity, same surrogate; other entity, other surrogate.

1. Entities are found in each text and brought to a normal form, so that different spellings
   of one number, address or name are one entity.
2. Each distinct entity draws a surrogate of its own type, gender, script and format from a keyed
   stream. Rounds of checks over all entities settle collisions: a surrogate that is
   someone's real value, or that another entity has, is drawn again.
3. Every mention is replaced in the format it was written in.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from stockpond.llm.native import free_name, row_digest
from stockpond.session import materialize

# After so many draws in its own format a surrogate gets one character more with each draw, so rounds end.
SAME_LENGTH_DRAWS = 8

# Forms of address by gender (m, f, or u where the form does not tell).
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Signor", "Господин", "господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Signora", "Госпожа", "госпожа", "Κυρία"],
    "u": ["Dr", "Prof", "Professor"],
}
GENDERS = {title: gender for gender, titles in TITLES.items() for title in titles}

# Syllables for names by script; the last one carries the gender.
SYLLABLES = {
    "LATIN": ("ba be bi bo da de do fa fi ga ha ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi za".split(), {"f": ["na", "lia", "ra"], "m": ["no", "rick", "los"], "u": ["ren", "lin", "sey"], "": ["man", "ver", "ton", "sen"]}),
    "CYRILLIC": ("ба бе би бо ва ве ви да де ди до га за ка ки ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се со та те ти то".split(), {"f": ["на", "лия", "ра"], "m": ["мир", "слав", "рий"], "u": ["ля", "ша"], "": ["ко", "дзе", "ян"]}),
    "GREEK": ("βα βε γα γε δα δε κα κε κι λα λε λι μα με μι να νε νι πα πε ρα ρε ρι σα σε σι τα τε τι".split(), {"f": ["να", "λία", "ρα"], "m": ["νος", "ρης", "λος"], "u": ["λι"], "": ["δου", "κης", "πουλος"]}),
}
# First and last letter of scripts without syllables above.
LETTERS = {"CJK": (0x4E00, 0x9FA5), "HIRAGANA": (0x3042, 0x3093), "KATAKANA": (0x30A2, 0x30F3), "HANGUL": (0xAC00, 0xD7A3), "ARABIC": (0x0628, 0x063A), "HEBREW": (0x05D0, 0x05EA), "DEVANAGARI": (0x0915, 0x0939)}

_NAME = r"[\p{Lu}\p{Lo}][\p{L}'’]*(?:-[\p{Lu}][\p{L}]+)?"
FORMS = regex.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.\p{L}{2,})"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*[\"']?)(?P<secret>[^\s\"']{8,})"
    r"|(?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?P<card>(?<![\w.+-])\d{4}(?P<sep>[ -]?)\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}(?!\w))"
    r"|(?P<ssn>(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w))"
    r"|\b(?P<title>" + "|".join(sorted(map(regex.escape, GENDERS), key=len, reverse=True)) + r")\.?[ \t]+(?P<name>" + _NAME + r"(?:[ \t]" + _NAME + r"){0,2})"
)

# A line without any of these holds no entity; looking for them is far cheaper than matching forms.
SIGNS = re.compile(r"[\d@]")
WORDS = [*GENDERS, "password", "passwd", "pwd", "secret", "token", "api"]

MENTION = StructType([StructField(n, t) for n, t in (("at", IntegerType()), ("length", IntegerType()), ("kind", StringType()), ("normal", StringType()))])


def script(word: str) -> str:
    """Script of the first letter, as Unicode names it."""
    return next((unicodedata.name(c, "LATIN").split(" ")[0].split("-")[0] for c in word if c.isalpha()), "LATIN")


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdecimal())


def _suspect(text: str) -> bool:
    return bool(SIGNS.search(text)) or any(w in text for w in GENDERS) or any(w in text.casefold() for w in WORDS[len(GENDERS) :])


def _matches(text: str) -> Iterator[tuple[int, regex.Match]]:
    """Matches of the forms with the start of their line; no form spans lines."""
    if not _suspect(text):
        return
    start = 0
    for line in text.split("\n"):
        if _suspect(line):
            for match in FORMS.finditer(line):
                yield start, match
        start += len(line) + 1


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, length, kind, normal form) of all entities, left to right, without overlaps.

    Names are found behind a form of address; from then on they are found anywhere in the text.
    A name is a family name and given names, each an entity, so that parts of it refer alike.
    """
    found, names, taken = [], {}, []
    for start, match in _matches(text):
        title = match.group("title")
        if title is None:
            kind = next(k for k in ("email", "ip", "secret", "key", "card", "ssn", "phone") if match.group(k) is not None)
            value, a, b = match.group(kind), start + match.start(kind), start + match.end(kind)
            if kind == "phone":
                if not 7 <= len(_digits(value)) <= 15:
                    continue
                code = regex.match(r"\+(\d{1,3})(?=[ .(-])", value)
                normal = f"{code.group(1) if code else ''}|{_digits(value)[len(code.group(1)) if code else 0 :]}"
            else:
                normal = value.lower() if kind == "email" else _digits(value) if kind in ("card", "ssn") else value
            found.append((a, b - a, kind, normal))
            taken.append((a, b))
            continue
        *given, family = match.group("name").split()
        names.setdefault(family.casefold(), "family")
        for word in given:
            names.setdefault(word.casefold(), f"given-{GENDERS[title]}")
    if names:
        for match in regex.finditer(r"(?<![\p{L}\p{N}])" + _NAME + r"(?![\p{L}\p{N}])", text):
            kind = names.get(match.group().casefold())
            if kind and not any(a < match.end() and match.start() < b for a, b in taken):
                found.append((match.start(), len(match.group()), f"{kind}-{script(match.group()).lower()}", match.group().casefold()))
    return sorted(found)


class Stream:
    """Numbers from a keyed hash of the entity and the draw."""

    def __init__(self, key: bytes, kind: str, normal: str, draw: int):
        self.key, self.seed, self.block, self.rest = key, f"{kind}|{draw}|{normal}".encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.rest) < 4:
            self.rest = hmac.new(self.key, self.seed + b"|%d" % self.block, hashlib.sha256).digest()
            self.block += 1
        value, self.rest = int.from_bytes(self.rest[:4], "big"), self.rest[4:]
        return value % n

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits, in case; hexadecimal stays hexadecimal."""
        top = 6 if all(c in "0123456789abcdefABCDEF" for c in text) else 26
        return "".join(
            str(self.below(10)) if c.isdecimal() else chr(97 + self.below(top)) if c.islower() else chr(65 + self.below(top)) if c.isupper() else c if not c.isalpha() else self.letter(c)
            for c in text
        )

    def letter(self, c: str) -> str:
        low, high = LETTERS.get(script(c), (0x61, 0x7A))
        return chr(low + self.below(high - low + 1))


def luhn(digits: str) -> int:
    """Check sum of a card number: 0 if it is valid."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def surrogate(key: bytes, kind: str, normal: str, draw: int) -> str:
    """The ``draw``-th surrogate of an entity, in normal form."""
    stream, more = Stream(key, kind, normal, draw), max(0, draw - SAME_LENGTH_DRAWS)
    if kind == "ip":
        return ".".join(str(1 + stream.below(254)) for _ in range(4))
    if kind == "email":
        name, _, domain = normal.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{stream.like(name + 'x' * more)}@{stream.like(host)}.{top}"
    if kind == "key":
        return normal[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[stream.below(32)] for _ in range(len(normal) - 4 + more))
    if kind == "secret":
        return stream.like(normal + "0" * more)
    if kind == "phone":
        code, _, number = normal.partition("|")
        return f"{code}|{2 + stream.below(8)}{stream.like('0' * (len(number) - 1 + more))}"
    if kind == "ssn":
        return f"{1 + stream.below(8)}{stream.like('0' * (8 + more))}"
    if kind == "card":
        body = normal[0] + stream.like("0" * (len(normal) - 2 + more))
        last = str((10 - luhn(body + "0")) % 10)
        return body + (last if luhn(normal) == 0 else str((int(last) + 1 + stream.below(9)) % 10))
    role, *rest = kind.split("-")
    gender, letters = ("", rest[0]) if role == "family" else rest
    if letters.upper() not in SYLLABLES:
        return "".join(stream.letter(c) for c in normal + normal[-1:] * more)
    inner, endings = SYLLABLES[letters.upper()]
    ends = endings[gender]
    return "".join(inner[stream.below(len(inner))] for _ in range(2 + stream.below(2) + more)) + ends[stream.below(len(ends))]


def written_like(kind: str, new: str, old: str) -> str:
    """A surrogate in normal form, written the way ``old`` is."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new.replace("|", ""))
        out = "".join(next(digits) if c.isdecimal() else c for c in old)
        return out + "".join(digits)
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for n, o in zip(new, old)) + new[len(old) :]
    if kind in ("ip", "key", "secret"):
        return new
    return new.upper() if len(old) > 1 and old.isupper() else new[:1].upper() + new[1:] if old[:1].isupper() else new


def _found(texts: Column) -> Column:
    @F.pandas_udf(ArrayType(MENTION))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"at": a, "length": n, "kind": k, "normal": v} for a, n, k, v in mentions(t)] if t else [] for t in batch])

    # Called so that Spark doesn't search each text twice, once to filter and once to keep.
    return run.asNondeterministic()(texts)


def _drawn(key: bytes, draw: int) -> Column:
    @F.pandas_udf(StringType())
    def run(kinds: pd.Series, normals: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, n, draw) for k, n in zip(kinds, normals)])

    return run("kind", "normal")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``normal``, ``surrogate`` for the distinct entities: no surrogate twice within a kind, none that is a real value.

    A round draws for all entities without a surrogate, lets the smallest of those with the same draw
    have it, and sends the rest, and those who drew a real or given value, to the next round.
    """
    spark = entities.sparkSession
    pending = entities = materialize(entities.select("kind", "normal").distinct(), "entities")
    real = entities.withColumnRenamed("normal", "surrogate")
    given = spark.createDataFrame([], "kind string, normal string, surrogate string")
    draw = 0
    while not pending.isEmpty():
        drawn = materialize(pending.withColumn("surrogate", _drawn(key, draw)), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal"))
        free = first.join(real, ["kind", "surrogate"], "left_anti").join(given.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        given = materialize(given.unionByName(free), "given")
        pending = materialize(pending.join(given.select("kind", "normal"), ["kind", "normal"], "left_anti"), "pending")
        draw += 1
    return given


def _suspects(text: Column) -> Column:
    """Native form of ``_suspect``: false only for texts without an entity."""
    signs = text.rlike(r"[\p{Nd}@]")
    for word in GENDERS:
        signs = signs | text.contains(word)
    for word in WORDS[len(GENDERS) :]:
        signs = signs | F.lower(text).contains(word)
    return F.coalesce(signs, F.lit(False))


def with_surrogates(docs: DataFrame, key: bytes, id_col: str = "doc_id", text: str = "text", replaced: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced; ``replaced`` names a column for how many there were.

    Rows and other columns stay as they are, and so do texts without entities, null and empty ones.
    The same ``key`` and the same documents give the same texts on every run. Only texts that
    show a sign of an entity are searched and joined with their surrogates; the others are not shuffled.
    """
    suspect = _suspects(F.col(text))
    marked = docs.where(suspect)
    places = materialize(
        marked.select(row_digest(id_col, text).alias("_digest"), _found(F.col(text)).alias("m")).where(F.size("m") > 0).dropDuplicates(["_digest"]), "mentions"
    )
    listed = places.select("_digest", F.explode("m").alias("m")).select("_digest", "m.*")
    given = assign(listed.select("kind", "normal"), key)
    # As many as the text has entities.
    swaps = listed.join(given, ["kind", "normal"]).groupBy("_digest").agg(F.sort_array(F.collect_list(F.struct("at", "length", "kind", "surrogate"))).alias("_swaps"))
    digest, name = free_name(docs, "_digest"), free_name(docs, "_swaps")
    swaps = materialize(swaps.withColumnsRenamed({"_digest": digest, "_swaps": name}), "swaps")
    joined = marked.withColumn(digest, row_digest(id_col, text)).join(swaps, digest, "left")

    @F.pandas_udf(StringType())
    def swap(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for body, list_ in zip(texts, lists):
            pieces, end = [], 0
            for s in list_:
                old = body[s["at"] : s["at"] + s["length"]]
                pieces += [body[end : s["at"]], written_like(s["kind"], s["surrogate"], old)]
                end = s["at"] + s["length"]
            out.append("".join(pieces) + body[end:])
        return pd.Series(out)

    none = F.array().cast("array<struct<at:int,length:int,kind:string,surrogate:string>>")
    changed = joined.withColumn(name, F.coalesce(name, none)).withColumn(text, swap(F.col(text), F.col(name)))
    clear = docs.where(~suspect)
    if replaced:
        changed, clear = changed.withColumn(replaced, F.size(name)), clear.withColumn(replaced, F.lit(0))
    return clear.unionByName(changed.drop(digest, name))
