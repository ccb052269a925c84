"""Surrogates for personal data (operator 9).

Detected entities are replaced by keyed surrogates of their own type, script
and format: digits stay digits of their script and letters letters, at the same
places and in the same case; addresses keep their shape, card numbers their check digit, names
their gender and script. An entity is its canonical value, so all mentions of
one value get one surrogate, in every document (coreference). Most surrogates come from a keyed
permutation of the values of their format, so distinct values stay distinct;
a check over the whole table redraws those that still collide, or that equal a
value that occurs.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_columns, stored, table
from .textnp import parts, released

#: Key of the registered query and the pipeline; a deployment passes its own.
KEY = b"surrogates"
#: Redrawn entities that tasks get as a dictionary; more of them are joined to their documents.
INLINE_REDRAWS = 50_000
#: Redraws after which an address or secret gets longer, a letter a draw, as few values of its format are free.
SAME_LENGTH = 3
#: The same for kinds of fixed length, which get a digit a draw: only where nearly all values of the format occur.
SAME_DIGITS = 20
#: Characters of a value that are permuted as one; longer values go by pieces.
PIECE = 128

# Honorifics by gender, and syllables and endings of made-up names by script.
HONORIFICS = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Doña", "госпожа"],
    "n": ["Dr", "Prof"],
}
SYLLABLES = {
    "latin": ["ba", "bre", "ca", "cor", "da", "del", "fa", "fen", "ga", "gil", "ha", "hel", "jo", "ka", "kel", "la", "lin", "lo",
              "ma", "mar", "mi", "na", "nel", "no", "pa", "per", "ra", "ri", "ro", "sa", "sel", "ta", "tel", "to", "va", "vi"],
    "cyrillic": ["ба", "бо", "ва", "ви", "га", "го", "да", "де", "за", "зо", "ка", "ки", "ла", "ли", "ло", "ма", "ми", "мо",
                 "на", "ни", "но", "па", "пе", "ра", "ри", "ро", "са", "се", "та", "ти", "то", "фа", "фе", "ха", "хо", "ша"],
}
GIVEN_END = {("latin", "m"): "rn", ("latin", "f"): "na", ("latin", "n"): "l",
             ("cyrillic", "m"): "слав", ("cyrillic", "f"): "на", ("cyrillic", "n"): "й"}
FAMILY_END = {("latin", "m"): "son", ("latin", "f"): "son", ("latin", "n"): "son",
              ("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова", ("cyrillic", "n"): "ко"}

_GENDER = {h.lower(): g for g, hs in HONORIFICS.items() for h in hs}
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+(?:[-'’][A-ZÀ-ÖØ-ÞА-ЯЁ]?[a-zà-öø-ÿа-яё]+)*"
_SEP = r"[^\w\n(+]{1,6}"
_HEX = re.compile(r"[0-9a-fA-F]{32,}")
PATTERNS: list[tuple[str, str, re.Pattern]] = [  # kind, a character without which it cannot occur ("0": a digit), pattern
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![A-Za-z0-9])")),
    ("phone", "0", re.compile(rf"(?<![\w+])(?:\+\d{{1,3}}(?:{_SEP})?)?\(\d{{2,4}}\)(?:{_SEP})?\d{{3,4}}[ .-]?\d{{3,4}}(?!\w)"
                              r"|(?<![\w+.-])(?:\+\d{1,3}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)"
                              # grouped international: country code, then groups (an optional 0 in brackets), 8 digits at least
                              r"|(?<![\w+])\+(?=(?:[ \u00a0.()-]{0,3}\d){8})[1-9]\d{0,2}(?:[ \u00a0-]?\(0\)[ \u00a0-]?\d{1,10}(?:[ \u00a0-]\d{1,10}){0,5}"
                              r"|(?:[ \u00a0-]\d{1,10}){1,5}|(?:\.\d{1,4}){2,5})(?!\w)")),
    # ten plain digits (eleven after a 1) may be any number, so a word before them must say what they are
    ("phone", "0", re.compile(r"(?i)(?<!\w)(?:phone|telephone|tel|mobile|cell|fax|call|text|sms|whatsapp|reach|ring)"
                              r"(?:[ \u00a0]+(?:number|no|me|us|at|on|is)\b){0,3}[ \u00a0.:#=]{0,4}(?<!\w)(?P<v>1?[2-9]\d{9})(?!\w)")),
    ("ip", "0", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")),
    ("ssn", "0", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("card", "0", re.compile(r"(?<!\w)(?:\d{4}[ -]?){3}\d{4}(?!\w)|(?<!\w)\d{13,19}(?!\w)|(?<!\w)3\d{3}[ -]\d{6}[ -]\d{5}(?!\w)")),
    ("iban", "0", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("secret", "0", re.compile(r"(?<!\w)(?=[a-fA-F]*\d)(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?!\w)")),
    ("secret", "0", re.compile(r"(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,})(?!\w)")),
    ("secret", '"', re.compile(r"(?i)(?<!\w)(?:token|secret|password|passwd|api[_-]?key)[^\w\n]{0,3}[=:][^\w\n]{0,4}\"(?P<v>[^\"\s]{8,})\"")),
]
_NAME = re.compile(r"(?<!\w)(?P<h>(?i:" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r"))\.?[ \u00a0]+"
                   rf"(?P<v>{_CAP}(?:[ \u00a0]{_CAP})?)(?!\w)")
_HEADS = [f(h) for hs in HONORIFICS.values() for h in hs for f in (str, str.upper)]
_DIGIT = re.compile(r"\d")

Entity = tuple[str, str]  # kind (for names also part, gender and script) and canonical value


# ---------------------------------------------------------------- detection

def digits_of(text: str) -> str:
    """``text`` with the digits of every script as ASCII ones."""
    return text if text.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def canonical(kind: str, mention: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", digits_of(mention))
    if kind == "iban":
        return digits_of(mention.replace(" ", ""))
    if kind == "ip":
        return ".".join(str(int(x)) for x in mention.split("."))
    return mention.lower() if kind == "email" or _HEX.fullmatch(mention) else mention


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Non-overlapping mentions in order: start, end, kind, canonical value. At one place the longest wins."""
    found = []
    digits = _DIGIT.search(text) is not None
    for kind, must, pattern in PATTERNS:
        if not (digits if must == "0" else must in text):
            continue
        for m in pattern.finditer(text):
            a, z = m.span("v") if "v" in pattern.groupindex else m.span()
            value = canonical(kind, text[a:z])
            if kind == "card" and value.isdigit() and text[a:z].isdecimal() and luhn(value[:-1]) != int(value[-1]):
                continue  # a plain run of digits is a card only by its check digit
            found.append((a, z, kind, value))
    for m in _NAME.finditer(text) if any(h in text for h in _HEADS) else ():
        gender, at = _GENDER[m["h"].lower()], m.start("v")
        parts = re.split("[ \u00a0]", m["v"])
        for k, p in enumerate(parts):
            role = "given" if len(parts) == 2 and k == 0 else "family"
            script = "cyrillic" if "\u0400" <= p[0] <= "\u04ff" else "latin"
            # a family name is one entity whoever bears it, so that "Mr X Y" and "Mrs Y" stay related
            found.append((at, at + len(p), f"name/{role}/{gender if role == 'given' or script == 'cyrillic' else 'n'}/{script}", p.lower()))
            at += len(p) + 1
    out, end = [], 0
    for f in sorted(found, key=lambda f: (f[0], -f[1], f[2])):
        if f[0] >= end:
            out.append(f)
            end = f[1]
    return out


# ---------------------------------------------------------------- surrogates

class Surrogates:
    """Keyed replacement of canonical values; ``draw`` counts redraws after collisions."""

    def __init__(self, key: bytes):
        self.key = key
        self.cache: dict[tuple[str, str, int], str] = {}

    def _number(self, *parts) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, parts)).encode(), hashlib.sha512).digest(), "big")

    def permute(self, values: list[int], radices: list[int], *tweak) -> list[int]:
        """Keyed permutation of the tuples below ``radices``: an alternating Feistel network on two halves."""
        if len(values) < 2:
            return [(v + self._number("one", r, *tweak)) % r for v, r in zip(values, radices, strict=True)]
        half = len(values) // 2
        sides, sizes = [], []
        for vs, rs in ((values[:half], radices[:half]), (values[half:], radices[half:])):
            x, size = 0, 1
            for v, r in zip(vs, rs, strict=True):
                x, size = x * r + v, size * r
            sides.append(x)
            sizes.append(size)
        for turn in range(10):
            a = turn % 2
            sides[a] = (sides[a] + self._number(turn, sides[1 - a], radices, *tweak)) % sizes[a]
        out: list[int] = []
        for x, rs in zip(sides, (radices[:half], radices[half:]), strict=True):
            part = []
            for r in reversed(rs):
                x, v = divmod(x, r)
                part.append(v)
            out += reversed(part)
        return out

    def _shape(self, value: str, *tweak, hexadecimal: bool = False) -> str:
        """Permute letters among letters and digits among digits, each of its own script; other characters stay."""
        if len(value) > PIECE:
            tweak = (*tweak, self._number("whole", value))
            return "".join(self._shape(value[i:i + PIECE], *tweak, i, hexadecimal=hexadecimal) for i in range(0, len(value), PIECE))
        letters = ["0123456789abcdef"] * len(value) if hexadecimal else [alphabet(c) for c in value]
        places = [i for i, x in enumerate(letters) if len(x) > 1]
        mask = len(value) if hexadecimal else "".join(x[0] for x in letters)
        new = self.permute([letters[i].index(value[i]) for i in places], [len(letters[i]) for i in places], *tweak, mask)
        out = list(value)
        for i, v in zip(places, new, strict=True):
            out[i] = letters[i][v]
        return "".join(out)

    def canonical(self, kind: str, value: str, draw: int = 0) -> str:
        """Canonical surrogate of a canonical value, never the value itself unless its format has no other."""
        k = (kind, value, draw)
        if k not in self.cache:
            if len(self.cache) > 200_000:
                self.cache.clear()
            for more in range(8):
                out = self._draw(kind, value, draw + more * 1000)
                if out != value:
                    break
            self.cache[k] = out
        return self.cache[k]

    def _draw(self, kind: str, value: str, draw: int) -> str:
        if kind == "ip":
            return ".".join(map(str, self.permute([int(x) for x in value.split(".")], [256] * 4, kind, draw))) + self._more(kind, value, draw, ".")
        if kind == "card":  # the check digit keeps its distance from the right one
            head = self._shape(value[:-1], kind, draw) + self._more(kind, value, draw)
            return head + str((luhn(head) + int(value[-1]) - luhn(value[:-1])) % 10)
        if kind == "email":
            local, _, domain = value.partition("@")
            labels = domain.split(".")
            keep = 2 if domain.endswith((".example.com", ".example.net", ".example.org")) else 1
            own = ".".join(labels[:-keep])  # a domain has one surrogate, whoever uses it
            return self._shape(local, kind, domain, draw) + self._longer(kind, value, draw) + "@" + ".".join(
                filter(None, [self._shape(own, "domain", 0) if own else "", *labels[-keep:]]))
        if kind.startswith("name/"):
            _, role, gender, script = kind.split("/")
            n, parts, syllables = self._number(kind, value, draw), "", SYLLABLES[script]
            for _ in range(3 + draw % 1000):  # one syllable more with each redraw, so there are always more names than entities
                n, i = divmod(n, len(syllables))
                parts += syllables[i]
            return parts + (GIVEN_END if role == "given" else FAMILY_END)[script, gender]
        if kind == "secret" and not _HEX.fullmatch(value):
            return self._shape(value, kind, draw) + self._longer(kind, value, draw)
        return self._shape(value, kind, draw, hexadecimal=kind == "secret") + self._more(kind, value, draw)

    def _longer(self, kind: str, value: str, draw: int) -> str:
        """Letters that a redraw appends where the format has too few values (one letter before the @, no letter at all)."""
        n, out = self._number("longer", kind, value, draw), ""
        for _ in range(draw % 1000 - SAME_LENGTH):
            n, i = divmod(n, 26)
            out += chr(97 + i)
        return out

    def _more(self, kind: str, value: str, draw: int, before: str = "") -> str:
        """Digits that late redraws append to a kind of fixed length."""
        n = draw % 1000 - SAME_DIGITS
        return before + str(self._number("more", kind, value, draw) % 10 ** n).zfill(n) if n > 0 else ""

    def render(self, kind: str, mention: str, surrogate: str) -> str:
        """The surrogate in the format of a mention, with digits of the mention's script."""
        if kind in ("phone", "card", "ssn", "iban"):
            it, last = iter(surrogate), "0"
            out = []
            for c in mention:
                if c.isdecimal() or kind == "iban" and c != " ":
                    last = c if c.isdecimal() else last
                    c = in_script(next(it), c)
                out.append(c)
            return "".join(out) + "".join(in_script(d, last) for d in it)
        if kind == "ip":
            return "".join(in_script(d, next(c for c in mention if c.isdecimal())) for d in surrogate)
        if kind.startswith("name/"):
            return surrogate[0].upper() + surrogate[1:] if not mention.isupper() else surrogate.upper()
        if kind == "email" or kind == "secret" and _HEX.fullmatch(mention):
            if mention.isupper():
                return surrogate.upper()
            return "".join(s.upper() if i < len(mention) and mention[i].isupper() else s for i, s in enumerate(surrogate))
        return surrogate


def in_script(d: str, like: str) -> str:
    """The digit ``d`` among the digits that ``like`` belongs to; other characters as they are."""
    if d.isascii() and d.isdigit() and like.isdecimal() and not like.isascii():
        return chr(ord(like) - unicodedata.decimal(like) + int(d))
    return d


@lru_cache(maxsize=1 << 16)
def alphabet(c: str) -> str:
    """The characters that may stand for ``c``: digits of its script, or letters of its case nearby; else itself alone."""
    if c.isdecimal():
        return "".join(chr(ord(c) - unicodedata.decimal(c) + i) for i in range(10))
    if not c.isalpha():
        return c
    if c.isascii():
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz"
    first, category = ord(c) & ~31, unicodedata.category(c)
    return "".join(x for x in map(chr, range(first, first + 32)) if unicodedata.category(x) == category)


def luhn(head: str) -> int:
    """The check digit that completes ``head``."""
    total = 0
    for i, c in enumerate(reversed(head)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


# ---------------------------------------------------------------- tables

def mentions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, start, end, kind and value of every mention in every whole text (null: none)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in parts(batches, 1):
            rows, spans = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for s in detect(t or ""):
                    rows.append(i)
                    spans.append(s)
            c = list(zip(*spans, strict=True)) if spans else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(c[0], pa.int32()), pa.array(c[1], pa.int32()),
                 pa.array(c[2], pa.string()), pa.array(c[3], pa.string())], names=[key, "start", "end", "kind", "value"])

    return docs.select(key, text).mapInArrow(released(run), f"`{key}` {kind}, start int, end int, kind string, value string")


def redraws(entities: DataFrame, key: bytes, draw: Callable | None = None) -> DataFrame:
    """(kind, value, draw) of the distinct ``entities`` whose surrogate needs another draw than the first.

    A surrogate that two entities of a kind share goes to the one with fewer
    draws, then the smaller value; one that occurs as a value goes to nobody.
    Surrogates get longer with their redraws (those of fixed length only after
    many), so there are always more values than entities and the rounds end.
    """
    make = draw or (lambda kind, value, n, s: s.canonical(kind, value, n))

    def surrogate(batches: Iterator[pa.RecordBatch]):
        s = Surrogates(key)
        for b in batches:
            k, v, n = (b.column(i) for i in range(3))
            out = [make(*x, s) for x in zip(k.to_pylist(), v.to_pylist(), n.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([k, v, n, pa.array(out, pa.string())], names=["kind", "value", "draw", "s"])

    own = entities.select("kind", "value")
    state = own.withColumn("draw", F.lit(0))
    while True:
        state = stored(state.mapInArrow(released(surrogate), "kind string, value string, draw int, s string"), "pii_draws")
        first = state.groupBy("kind", "s").agg(F.min(F.struct("draw", "value")).alias("first"), F.count(F.lit(1)).alias("c"))
        taken = own.withColumnRenamed("value", "s").withColumn("taken", F.lit(True))
        bad = first.join(taken, ["kind", "s"], "left").where("c > 1 or taken")
        bad = stored(bad.select("kind", "s", "first", "taken"), "pii_collisions")
        if bad.isEmpty():
            return state.where("draw > 0").select("kind", "value", "draw")
        lose = F.col("taken").isNotNull() | (F.col("first").isNotNull() & (F.col("first.value") != F.col("value")))
        state = state.join(bad, ["kind", "s"], "left").select(
            "kind", "value", (F.col("draw") + F.when(lose, 1).otherwise(0)).alias("draw"))


def replace_all(docs: DataFrame, key: str = "doc_id", text: str = "text", secret: bytes = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with every detected entity replaced, all other columns unchanged.

    ``count`` names an optional column with the number of mentions. Null and
    empty texts stay as they are; null keys and repeated rows are treated like
    any other; an empty table stays empty.
    """
    found = stored(mentions(docs, key, text), "pii_mentions")
    again = redraws(stored(found.select("kind", "value").distinct(), "pii_entities"), secret)
    at, extra = docs.columns.index(text), [F.col(c) for c in docs.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + (f", `{count}` int" if count else "")
    own: dict[Entity, int] = {}
    if again.count() <= INLINE_REDRAWS:
        own = {(r["kind"], r["value"]): r["draw"] for r in again.collect()}
        frame = docs
    else:  # each document gets the redraws of its own entities
        (column,) = fresh_columns(docs, "_redraws")
        per = found.join(again, ["kind", "value"]).groupBy(F.col(key).alias("_k")).agg(
            F.collect_set(F.struct("kind", "value", "draw")).alias(column))
        frame = docs.join(per, F.col(key).eqNullSafe(F.col("_k")), "left").select(*extra, column)
    joined, names = frame is not docs, [*docs.columns, *([count] if count else [])]

    def run(batches):
        s = Surrogates(secret)
        for b in parts(batches, at):
            texts, counts = [], []
            drawn = b.column(b.num_columns - 1).to_pylist() if joined else None
            for i, t in enumerate(b.column(at).to_pylist()):
                spans = detect(t) if t else []
                draws = {(x["kind"], x["value"]): x["draw"] for x in drawn[i] or ()} if joined else own
                if spans:
                    out, end = [], 0
                    for a, z, kind, value in spans:
                        out += [t[end:a], s.render(kind, t[a:z], s.canonical(kind, value, draws.get((kind, value), 0)))]
                        end = z
                    t = "".join([*out, t[end:]])
                texts.append(t)
                counts.append(len(spans))
            columns = [b.column(i) for i in range(b.num_columns - joined)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(counts, pa.int32())] if count else []),
                                             names=names)

    return frame.mapInArrow(released(run), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, text with surrogates, number of mentions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_all(docs, count="n_entities")
