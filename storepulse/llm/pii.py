"""PII surrogates: keyed, type-consistent replacements of detected entities.

Detected are e-mail addresses, IPv4 addresses, card-like digit runs, phone numbers, social security
numbers, IBANs, access keys, secrets after a name such as ``password`` or
``token``, and person names after a title or made of a listed given name and a surname.

A surrogate comes from a keyed permutation of all values of the entity's
form, so no table of entities is needed: every task finds the same surrogate for the
same entity (coreference), two entities of a form never share one
(distinctness), and no entity is its own surrogate.

* A form fixes separators, and for each place the class of its character: digits
  stay digits, letters of a script and case stay such letters (vowels vowels, consonants consonants),
  so format and script are kept. Case is kept from the mention, the surrogate
  comes from the lower-cased entity.
* Properties are kept by walking on along the permutation's cycle until they
  match: a private address stays private, a card number keeps whether its check
  digit is right, an area code whether it could be one.
* A given name maps to another of the same gender and script.

The permutation is ``P^-1(P(x) + 1)`` for a Feistel network ``P`` keyed with the
secret, the type and the form. ``surrogates`` first checks the corpus for
collisions (two entities of a type with one surrogate, by 128-bit digests) and uses the
next tweak of the key if there are any; collisions under ``TWEAKS`` keys are an error that
names their types. Spellings of one address (``01.2.3.4``, ``1.2.3.4``) are one entity.
Text without a character that a surrogate could change (``________`` for a password) is none.

Null text stays null and has no entities; empty text stays empty. Text outside
entities is unchanged. Repeated rows get the same result. Extra columns
pass through; result columns replace those of the same name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Production parameters. The key is a stand-in: pass a secret one.
KEY = "storepulse-surrogates"
#: Tweaks of the key that are tried.
TWEAKS = 4

# ---- detection: fixed patterns ----------------------------------------------------

_TITLES_F = "Mrs|Ms|Miss|Frau|Madame|Mme|Mademoiselle|Señora|Sra|Señorita|Signora|Госпожа|Κυρία"
_TITLES_M = "Mr|Herr|Monsieur|Señor|Sr|Signor|Господин|Κύριος"
_TITLES_N = "Dr|Prof|Professor|Doktor|Docteur|Doctor"
#: Given names by (gender, script).
GIVEN = {
    ("f", "latin"): "Margaret Katherine Elizabeth Charlotte Beatrice Josephine Rebecca Veronica Gabriele Ingeborg Brigitte Mathilde Monique Jacqueline Guadalupe Dolores".split(),
    ("m", "latin"): "Nicholas Frederick Benjamin Jonathan Theodore Christopher Wolfgang Friedrich Günther Joachim Guillaume Sébastien Grégoire Francisco Rodrigo Gonzalo".split(),
    ("f", "cyrillic"): "Екатерина Елизавета Маргарита Светлана Людмила Валентина Наталья Татьяна".split(),
    ("m", "cyrillic"): "Александр Владимир Константин Николай Дмитрий Григорий Станислав Вячеслав".split(),
    ("f", "greek"): "Αικατερίνη Ελισάβετ Ευαγγελία Παρασκευή".split(),
    ("m", "greek"): "Αλέξανδρος Κωνσταντίνος Δημήτριος Παναγιώτης".split(),
}
_GIVEN_OF = {name.lower(): group for group, names in GIVEN.items() for name in names}
_UPPER = "A-ZÀ-ÖØ-ÞА-ЯΑ-ΩΆ-Ώ"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿА-Яа-яёЁΑ-Ωα-ωΆ-ώ"
_WORD = rf"[{_UPPER}][{_LETTER}]+(?:[-'’][{_UPPER}][{_LETTER}]+)?"
_GIVEN_WORDS = "|".join(sorted((n for names in GIVEN.values() for n in names), key=len, reverse=True))

#: Entities with a digit or sign; they lie within one line.
_CODED = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))"
    r"|(?:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b[ \t]*[=:][ \t]*[\"']?(?P<secret>[A-Za-z0-9+/_\-]{8,}))"
    r"|(?P<key>\bAKIA[A-Z0-9]{16}\b)"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d.])(?:\d{4}[ -]){3}\d{4}(?!\d)|(?<![\d.])\d{13,19}(?!\d))"
)
_SIGN = re.compile(r"[0-9@=:]|AKIA")
_NAME = re.compile(
    rf"(?:{_TITLES_F}|{_TITLES_M}|{_TITLES_N})\.?[ ](?P<titled>{_WORD}(?:[ ]{_WORD}){{0,2}})"
    rf"|(?P<named>(?:{_GIVEN_WORDS})[ ]{_WORD})(?!\w)"
)


#: What a name begins with: plain alternatives, which are quick to search for.
_NAME_START = re.compile(f"{_TITLES_F}|{_TITLES_M}|{_TITLES_N}|{_GIVEN_WORDS}")


def _coded(text: str) -> Iterator[tuple[int, int, str]]:
    """Entities of the lines that have a digit or sign at all."""
    at = 0
    while sign := _SIGN.search(text, at):
        start = max(at, text.rfind("\n", 0, sign.start()) + 1)
        at = text.find("\n", sign.start())
        at = len(text) if at < 0 else at
        for m in _CODED.finditer(text, start, at):
            yield *m.span(m.lastgroup), m.lastgroup


def entities(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities, in order, without overlap; the earlier one wins."""
    if not text:
        return []
    found = list(_coded(text))
    for start in _NAME_START.finditer(text):
        before = text[start.start() - 1 : start.start()]
        if not (before.isalnum() or before == "_") and (m := _NAME.match(text, start.start())):
            found.append((*m.span(m.lastgroup), "name"))
    out, at = [], 0
    for start, end, kind in sorted(found):
        if start >= at and any(c in _CLASS_OF for c in text[start:end].lower()):
            out.append((start, end, kind))
            at = end
    return out


# ---- keyed permutations ---------------------------------------------------------------


class _Permutation:
    """Bijection of range(size) without a fixed point (size over 1), from a Feistel network with cycle walking."""

    ROUNDS = 6

    def __init__(self, key: bytes, size: int):
        self.key, self.size = key, size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1

    def _round(self, i: int, x: int) -> int:
        data = i.to_bytes(1, "big") + x.to_bytes((self.half + 7) // 8, "big")
        digest = hashlib.blake2b(data, key=self.key, digest_size=max(8, (self.half + 7) // 8)).digest()
        return int.from_bytes(digest, "big") & self.mask

    def _network(self, x: int, back: bool) -> int:
        left, right = x >> self.half, x & self.mask
        for i in reversed(range(self.ROUNDS)) if back else range(self.ROUNDS):
            if back:
                left, right = right ^ self._round(i, left), left
            else:
                left, right = right, left ^ self._round(i, right)
        return left << self.half | right

    def _walk(self, x: int, back: bool) -> int:
        x = self._network(x, back)
        while x >= self.size:
            x = self._network(x, back)
        return x

    def __call__(self, x: int) -> int:
        return self._walk((self._walk(x, False) + 1) % self.size, True)


#: Character classes that stand for each other; the case is put back from the mention.
_CLASSES = [
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâäèéêëìíîïòóôöùúûü", "ãåæçñøœßðþýÿõ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ",
]
_CLASS_OF = {ch: (no, i) for no, chars in enumerate(_CLASSES) for i, ch in enumerate(chars)}


def _permuted(text: str, key: bytes, same: Callable[[str], object] | None = None, classes=None) -> str:
    """Another text of the same form; ``same`` names a property that must stay."""
    classes = classes or _CLASS_OF
    chars = list(text)
    free = [(i, *classes[ch]) for i, ch in enumerate(chars) if ch in classes]
    sizes = [len(_CLASSES[no]) if classes is _CLASS_OF else 16 for _, no, _ in free]
    total, x = 1, 0
    for (_, _, digit), size in zip(free, sizes, strict=True):
        total, x = total * size, x * size + digit
    if total == 1:
        return text
    form = "".join(f"<{classes[ch][0]}>" if ch in classes else ch for ch in chars)
    turn = _Permutation(hashlib.blake2b(form.encode(), key=key, digest_size=32).digest(), total)
    wanted = same(text) if same else None
    while True:
        x = rest = turn(x)
        for (i, no, _), size in zip(reversed(free), reversed(sizes), strict=True):
            rest, digit = divmod(rest, size)
            chars[i] = _CLASSES[no][digit] if classes is _CLASS_OF else "0123456789abcdef"[digit]
        out = "".join(chars)
        if not same or same(out) == wanted:
            return out


_HEX_OF = {ch: (0, i) for i, ch in enumerate("0123456789abcdef")}


def _cased(made: str, like: str) -> str:
    return "".join(m.upper() if o.isupper() and len(m.upper()) == 1 else m for m, o in zip(made, like, strict=True))


def _luhn(text: str) -> int:
    total = 0
    for i, ch in enumerate(reversed([c for c in text if c.isdigit()])):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _ip_kind(address: int) -> str:
    """Class of an address that its surrogate keeps."""
    a, b = address >> 24, address >> 16 & 255
    if a == 10 or (a, b) == (192, 168) or (a == 172 and 16 <= b < 32):
        return "private"
    return "loopback" if a == 127 else "other" if a == 0 or a >= 224 else "public"


def _ip(text: str, key: bytes) -> str:
    address = int.from_bytes(bytes(int(p) for p in text.split(".")), "big")
    turn, kind = _Permutation(key, 1 << 32), _ip_kind(address)
    address = turn(address)
    while _ip_kind(address) != kind:
        address = turn(address)
    return ".".join(map(str, address.to_bytes(4, "big")))


def _card(text: str, key: bytes) -> str:
    """The last digit follows from the others: the check sum stays what it was."""
    made = _permuted(text[:-1], key)
    return next(out for d in "0123456789" if _luhn(out := made + d) == _luhn(text))


def surrogate(kind: str, entity: str, key: bytes) -> str:
    """Replacement of an entity; a function of the key, the type and the lower-cased entity, cased like the mention."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in entity)
    own = hashlib.blake2b(kind.encode(), key=key, digest_size=32).digest()
    if kind == "email":
        local, _, domain = low.partition("@")
        labels, _, top = domain.rpartition(".")
        made = f"{_permuted(local, own)}@{_permuted(labels, hashlib.blake2b(b'domain', key=own, digest_size=32).digest())}.{top}"
    elif kind == "ip":
        return _ip(entity, own)
    elif kind == "card":
        made = _card(low, own)
    elif kind == "phone":
        country = re.match(r"\+\d{1,3}(?=[ .(-])", low)
        at = country.end() if country else 0
        made = low[:at] + _permuted(low[at:], own, lambda t: next((c in "01" for c in t if c.isdigit()), False))
    elif kind == "key":
        made = low[:4] + _permuted(low[4:], own)
    elif kind == "iban":
        made = low[:2] + _permuted(low[2:], own)
    elif kind == "secret":
        made = _permuted(low, own, classes=_HEX_OF if re.fullmatch("[0-9a-f]+", entity) else None)
    elif kind == "name":
        made = " ".join(_name_part(p, own) for p in low.split(" "))
    else:
        made = _permuted(low, own)
    return _cased(made, entity) if len(made) == len(entity) else _titled(made)


def _name_part(word: str, key: bytes) -> str:
    group = _GIVEN_OF.get(word)
    if group is None:
        return _permuted(word, key)
    names = GIVEN[group]
    at = [n.lower() for n in names].index(word)
    return names[_Permutation(hashlib.blake2b("/".join(group).encode(), key=key, digest_size=32).digest(), len(names))(at)].lower()


def _titled(name: str) -> str:
    return re.sub(r"(?:^|(?<=[ '’-]))\w", lambda m: m[0].upper(), name)


def replaced(text: str, key: bytes, known: dict | None = None) -> tuple[str, list[tuple[str, str, str]]]:
    """(text with surrogates, [(type, entity, surrogate)])."""
    known = {} if known is None else known
    parts, made, at = [], [], 0
    for start, end, kind in entities(text):
        entity = text[start:end]
        new = known.get((kind, entity))
        if new is None:
            new = known[(kind, entity)] = surrogate(kind, entity, key)
        parts += [text[at:start], new]
        made.append((kind, entity, new))
        at = end
    return "".join([*parts, text[at:]]) if made else text, made


# ---- Spark -----------------------------------------------------------------------------


def tweaked(key: str, tweak: int) -> bytes:
    return hashlib.blake2b(f"{tweak}:{key}".encode(), digest_size=32).digest()


def canonical(kind: str, entity: str) -> str:
    """The entity that a mention is one of."""
    return ".".join(str(int(p)) for p in entity.split(".")) if kind == "ip" else entity.lower()


def _digest(*parts: str) -> bytes:
    return hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _pairs(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {
                (kind, _digest(kind, canonical(kind, entity)), _digest(kind, canonical(kind, new)))
                for text in batch.column(0).to_pylist()
                if text
                for kind, entity, new in replaced(text, key)[1]
            }
            kinds, was, now = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(was, pa.binary()), pa.array(now, pa.binary())],
                names=["kind", "entity", "surrogate"],
            )

    return run


def collisions(docs: DataFrame, key: bytes) -> dict[str, int]:
    """By type, the surrogates in the corpus that stand for more than one entity or for themselves."""
    pairs = docs.select("text").mapInArrow(_pairs(key), "kind string, entity binary, surrogate binary")
    by_surrogate = pairs.groupBy("kind", "surrogate").agg(
        F.min("entity").alias("lo"), F.max("entity").alias("hi"), F.bool_or(F.col("entity") == F.col("surrogate")).alias("kept")
    )
    return {r["kind"]: r["n"] for r in by_surrogate.filter("lo < hi or kept").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a type


def _replace(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, known = [], [], {}
            for text in batch.column("text").to_pylist():
                new, made = replaced(text, key, known) if text else (text, [])
                texts.append(new)
                counts.append(len(made))
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(i) for i, n in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, "n_entities"])

    return run


def surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and ``n_entities`` (mentions replaced)."""
    for tweak in range(TWEAKS):
        found = collisions(docs, tweaked(key, tweak))
        if not found:
            break
    else:
        raise ValueError(f"surrogates collide under {TWEAKS} tweaks of the key, by type: {found}")
    rows = docs.drop(*[c for c in docs.columns if c.lower() == "n_entities"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_replace(tweaked(key, tweak)), f"{schema}, n_entities long")
