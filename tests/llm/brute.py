"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(number)):
        value = int(digit) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def entity_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            value = match.group()
            digits = re.sub("[^0-9]", "", value)
            if kind == "ip" and any(int(part) > 255 for part in value.split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, match.start(), match.end()))
    return found


def removed_tokens(docs: list[tuple[int | None, list]], length: int) -> list[list[bool]]:
    """Per document which tokens a window covers that also starts in a document with a smaller id."""
    last = 1 << 63
    first: dict[tuple, int] = {}
    for doc_id, tokens in docs:
        key = last if doc_id is None else doc_id
        for p in range(len(tokens) - length + 1):
            window = tuple(tokens[p : p + length])
            first[window] = min(first.get(window, last), key)
    masks = []
    for doc_id, tokens in docs:
        key = last if doc_id is None else doc_id
        mask = [False] * len(tokens)
        for p in range(len(tokens) - length + 1):
            if first[tuple(tokens[p : p + length])] < key:
                mask[p : p + length] = [True] * length
        masks.append(mask)
    return masks


def n_runs(mask: list[bool]) -> int:
    return sum(1 for i, gone in enumerate(mask) if gone and (i == 0 or not mask[i - 1]))
