"""The contracts once more, written plainly for one text at a time."""

from __future__ import annotations

import re
from hashlib import sha256

LETTERS = {c: f"[{c}{c.upper()}]" for c in "abcdefghijklmnopqrstuvwxyz"}


def either_case(word: str) -> str:
    return "".join(LETTERS.get(c, c) for c in word)


KEYWORDS = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def secrets(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return in_order(found, ("assign", "access", "hex"))


def in_order(found, kinds) -> list[tuple[str, int, int]]:
    spans = [(kind, m.start(), m.end()) for kind, m in found]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def personal(text: str) -> list[tuple[str, int, int]]:
    found = [("email", m) for m in EMAIL.finditer(text)]
    small = re.compile("0*([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])")
    found += [("ip", m) for m in IP.finditer(text) if all(map(small.fullmatch, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m))
    found += [("phone", m) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return in_order(found, ("email", "ip", "card", "phone"))


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()
