"""Personal data replaced by keyed, type-consistent surrogates.

The surrogate of an entity depends only on the key, the type and the canonical form, so one
entity has one surrogate in all documents (coreference).  Numbers go through a keyed
permutation of all numbers of their length that keeps the format, the first digit's being
zero or not, and whether the card checksum holds: different numbers never share a surrogate.
Addresses of mail and secrets get strings of the same shape from a keyed stream, names after
a title get names of the same gender and script.  A stream value that is already the
original or the surrogate of another entity of the document is drawn again.

Null texts stay null; empty texts and texts without personal data stay as they are.  All
other columns are carried.
"""

from __future__ import annotations

import hashlib
import hmac
import re

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import add_columns, documents

KEY = "surrogates"
_NAME = r"[^\W\d_a-zà-öø-ÿа-я][^\W\d_]+"
_ENTITY = re.compile(
    r"(?P<email>[^\s@<>\"'(),;:|=]+@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?![\w-]))"
    r"|(?P<secret>(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|(?=[a-f0-9]*\d)[a-f0-9]{32,}|(?:sk|pk|ghp|xox[bp])[-_][A-Za-z0-9_-]{16,})(?![A-Za-z0-9]))"
    r"|(?P<male>(?<=\bMr )" + _NAME + r"|(?<=\bMr\. )" + _NAME + r"|(?<=\bHerr )" + _NAME + r"|(?<=\bSeñor )" + _NAME + r"|(?<=\bMonsieur )" + _NAME + r")"
    r"|(?P<female>(?<=\bMrs )" + _NAME + r"|(?<=\bMrs\. )" + _NAME + r"|(?<=\bMs\. )" + _NAME + r"|(?<=\bFrau )" + _NAME + r"|(?<=\bSeñora )" + _NAME + r"|(?<=\bMadame )" + _NAME + r")"
)
_SYLLABLES = {"latin": "ba be bo da de do ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo".split(),
              "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва ве во".split()}
_ENDING = {("latin", "male"): "n", ("latin", "female"): "a", ("cyrillic", "male"): "н", ("cyrillic", "female"): "а"}


class Surrogates:
    def __init__(self, key: str) -> None:
        self.key = key.encode()

    def number(self, *parts: str) -> int:
        return int.from_bytes(hmac.new(self.key, "\0".join(parts).encode("utf-8", "replace"), hashlib.sha256).digest())

    def permuted(self, value: int, a: int, b: int, tag: str) -> int:
        """A permutation of range(a * b): rounds that change one half by a keyed number of the other."""
        high, low = divmod(value, b)
        for turn in range(4):
            low = (low + self.number(tag, str(turn), "l", str(high))) % b
            high = (high + self.number(tag, str(turn), "h", str(low))) % a
        return high * b + low

    def digits(self, digits: str, kind: str) -> str:
        """Another number of the same length; walks the permutation until the format agrees."""
        n = len(digits)
        a, b = 10 ** (n // 2), 10 ** (n - n // 2)
        want = (digits[0] == "0", _luhn(digits))
        value = int(digits)
        while True:
            value = self.permuted(value, a, b, f"{kind}{n}")
            made = str(value).zfill(n)
            if (made[0] == "0", _luhn(made)) == want:
                return made

    def shaped(self, text: str, tag: str, turn: int) -> str:
        """Letters for letters, digits for digits, from a keyed stream."""
        out = []
        state = 0
        for i, c in enumerate(text):
            state = self.number(tag, str(turn), str(i // 16), text) if i % 16 == 0 else state // 97
            if c.isdigit():
                out.append(str(state % 10))
            elif "a" <= c <= "f" and tag == "secret":
                out.append("abcdef"[state % 6])
            elif c.isalpha():
                letter = chr(97 + state % 26)
                out.append(letter.upper() if c.isupper() else letter)
            else:
                out.append(c)
        return "".join(out)

    def one(self, kind: str, text: str, turn: int) -> str:
        if kind in ("card", "ssn", "phone"):
            digits = "".join(c for c in text if c.isdigit())
            made = iter(self.digits(digits, "number"))
            return "".join(next(made) if c.isdigit() else c for c in text)
        if kind == "ip":
            parts = [int(x) for x in text.split(".")]
            if max(parts) > 255:
                return ".".join(self.digits(p.zfill(3), "octet") for p in text.split("."))
            number = int.from_bytes(bytes(parts))
            return ".".join(str(x) for x in self.permuted(number, 1 << 16, 1 << 16, "ip").to_bytes(4))
        if kind == "iban":
            return text[:2] + self.shaped(text[2:], "iban", turn)
        if kind == "email":
            local, domain = text.lower().rsplit("@", 1)
            code = self.number("email", str(turn), text.lower())
            tail = "".join("abcdefghijklmnopqrstuvwxyz"[code // 26**i % 26] for i in range(12))
            owner = self.number("domain", domain) % 26**6
            site = "".join("abcdefghijklmnopqrstuvwxyz"[owner // 26**i % 26] for i in range(6))
            shape = self.shaped(local, "local", turn)
            return f"{shape}.{tail}@{site}.example"
        if kind == "secret":
            return self.shaped(text, "secret", turn)
        script = "cyrillic" if "Ѐ" <= text[0] <= "ӿ" else "latin"
        code, listed = self.number(kind, str(turn), text.lower()), _SYLLABLES[script]
        name = "".join(listed[code // 30**i % 30] for i in range(4))[:-1] + _ENDING[script, kind]
        return name.upper() if text.isupper() else name.capitalize()

    def replace(self, text: str | None) -> tuple[str | None, int, list[str]]:
        """The text with surrogates, the number of entities, and their types in text order."""
        if not text:
            return text, 0, []
        found = [(m.start(), m.end(), m.lastgroup, m.group()) for m in _ENTITY.finditer(text) if _plausible(m.lastgroup, m.group())]
        if not found:
            return text, 0, []
        originals = {e.lower() for *_, e in found}
        made: dict[tuple[str, str], str] = {}
        taken: dict[str, tuple[str, str]] = {}
        out, at = [], 0
        for start, end, kind, entity in found:
            who = (kind, entity.lower() if kind in ("email", "male", "female") else entity)
            if who not in made:
                turn = 0
                value = self.one(kind, entity, turn)
                while kind in ("email", "iban", "secret", "male", "female") and (value.lower() in originals or taken.get(value.lower(), who) != who):
                    turn += 1
                    value = self.one(kind, entity, turn)
                made[who] = value
                taken[value.lower()] = who
            out += [text[at:start], made[who]]
            at = end
        return "".join([*out, text[at:]]), len(found), [k for *_, k, _ in found]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _plausible(kind: str, text: str) -> bool:
    if kind == "phone":
        return 7 <= sum(c.isdigit() for c in text) <= 15
    return True


def surrogates(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with the text replaced, ``n_entities`` and ``entity_types`` added."""

    def make():
        replace = Surrogates(key).replace
        return lambda texts: [replace(t) for t in texts]

    names = [c for c in docs.columns if c not in ("n_entities", "entity_types")]
    return add_columns(docs, f"`{text}` string, n_entities long, entity_types array<string>", make, text).select(*names, "n_entities", "entity_types")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates(documents(spark, sf_dir).select("doc_id", "text"))
