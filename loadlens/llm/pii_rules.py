"""Patterns and checks for personal data: the base spans."""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns.  The look-behind and the possessive runs keep the scan linear
#: in long runs of digits and change no match.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TRIGGER = re.compile(r"[0-9@]")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part and domain, found from each @ outward, so long runs without one cost a single pass."""
    out, last = [], 0
    at = text.find("@")
    if at < 0:
        return out
    for run in LOCAL.finditer(text):
        a, b = max(run.start(), last), run.end()
        if a < b and text.startswith("@", b) and (m := DOMAIN.match(text, b)):
            last = m.end()
            out.append((a, last))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, by start, then kind as listed."""
    found = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
