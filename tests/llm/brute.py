"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def line_key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def kept_lines(rows):
    """(id, lines, kept lines) of each (id, text)."""
    holders = defaultdict(set)
    order = lambda i: (i is None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add(i)
    result = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(line_key(line)) < 10 or len(holders[line_key(line)]) < 2
                or min(holders[line_key(line)], key=order) == i]
        result.append((i, lines, kept))
    return result


def shingle_counts(text, size=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def weighted_jaccard(a, b):
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 0.0


def near_classes(rows, similarity=0.8):
    """The smallest id of the class of each row; rows are (id, text) with different ids."""
    texts = {i: text or "" for i, text in rows}
    counts = {i: shingle_counts(text) for i, text in rows}
    root = {i: i for i in counts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(counts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            same = weighted_jaccard(counts[i], counts[j]) >= similarity if counts[i] else not counts[j] and texts[i] == texts[j]
            if same:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        digit *= 1 + place % 2
        total += digit - 9 if digit > 9 else digit
    return total % 10 == 0


def personal(text):
    """(kind, start, end) of the base spans, by kind and start."""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 13 <= len(re.sub("[^0-9]", "", m.group())) <= 19 and luhn(re.sub("[^0-9]", "", m.group()))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in found]


def redacted(text, spans):
    """Each span as its kind in brackets; overlapping ones as the first."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], "" if kind == "remove" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
