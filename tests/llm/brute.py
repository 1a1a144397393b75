"""Plain versions of the corpus operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import regex

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def pii_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def pii_digest(text: str | None) -> tuple[list[int], str, str]:
    spans = pii_spans(text)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return [sum(s[0] == k for s in spans) for k in PII], hashlib.sha256(listed.encode()).hexdigest(), listed


NAMES = [*PII, "secret"]
GROUP = r"(?![0-9]++(?:\.[0-9]++){3})[0-9]++(?:[./-][0-9]++)*+(?=[.,;:!?)\]}\"']*+(?:[\x20\x09-\x0D]|\Z))"
WORD = rf"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D0-9@\p{{L}}]*+{GROUP}(?:\x20{GROUP})++|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)"


def lexical(piece: str) -> list[str]:
    return regex.findall(r"\p{L}+", piece.lower())


def pii_instances(text: str | None) -> list[dict]:
    """Words that may be identifiers: patterns with their number of words, value, place and seed (kind, value)."""
    text, out = text or "", []
    spans = [(NAMES.index(k), a, b) for k, a, b in pii_spans(text)]
    found = list(regex.finditer(WORD, text))
    for i, m in enumerate(found):
        before = text[found[i - 1].end() if i else 0 : m.start()]
        after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)]
        left, right = lexical(before.split("\n")[-1]), lexical(after.split("\n")[0])
        core = regex.search(r"[\p{L}0-9+].*(?<=[\p{L}0-9])", m[0])
        if not core:
            continue
        value = core[0].lower()
        a, b = m.start() + core.start(), m.start() + core.end()
        shape = re.sub("(?:9a)+9?|(?:a9)+a?", "x", regex.sub(r"\p{L}+", "a", re.sub("[0-9]+", "9", core[0])))
        forms = {}
        if left:
            edge = "^" if i == 0 and not before.strip() or "\n" in before or m.start() == len(before) else "#"
            forms[" ".join(left[-2:] if len(left) > 1 else [edge, left[0]])] = 2
            forms[f"{left[-1]} _"] = 1
            forms[f"{left[-1]} {shape}"] = 1
            if len(left) > 2:
                forms[" ".join([*left[-3:], "_"])] = 3
            if right:
                forms[f"{left[-1]} _ {right[0]}"] = 2
        if right:
            forms[f"_ {right[0]}"] = 1
        if len(right) > 1:
            forms["_ " + " ".join(right[:2])] = 2
        inside = [(k, text[x:y].lower()) for k, x, y in spans if x < b and a < y]
        seed = inside[0] if inside else (4, value) if re.match(r"[^a-zA-Z0-9]*[\"'][0-9a-f]{32,64}[\"']", m[0]) else None
        out.append({"forms": forms, "value": value, "start": a, "end": b, "seed": seed, "base": bool(inside)})
    return out


def looks_like(value: str) -> bool:
    return len(re.sub("[^0-9]", "", value)) >= 5 or bool(regex.search(r"[\p{L}0-9]@[\p{L}0-9]", value))


def pii_added(texts: list[str | None], rounds: int = 3, least: int = 3, sure_from: float = 0.8) -> list[list[tuple[str, int, int]]]:
    """Spans that the contexts of the whole corpus add to each text."""
    every = [pii_instances(t) for t in texts]
    edges, words = Counter(), {}
    seeds = {}
    for x in (x for found in every for x in found):
        name = x["seed"][1] if x["seed"] else x["value"]
        for form, n in x["forms"].items():
            edges[form, name] += 1
            words[form] = n
            if x["seed"]:
                seeds[form, name] = max(x["seed"][0], seeds.get((form, name), 0))
    known = {}
    for (_, name), kind in seeds.items():
        known[name, kind] = 1.0
    at_start, sure = dict(known), {}
    for _ in range(rounds):
        total, hit, different = Counter(), Counter(), Counter()
        by_name = {}
        for (name, kind), trust in known.items():
            by_name.setdefault(name, []).append((kind, trust))
        for (form, name), n in edges.items():
            total[form] += n
            for kind, trust in by_name.get(name, ()):
                hit[form, kind] += n * trust
                different[form, kind] += 1
        sure = {}
        for (form, kind), h in hit.items():
            confidence = min(1.0, h / total[form])
            if different[form, kind] >= least * (3 if words[form] == 1 else 1) and confidence >= sure_from:
                sure[form] = max(sure.get(form, (0, 0)), (confidence, -kind))
        known = dict(at_start)
        for form, name in edges:
            if (form, name) not in seeds and looks_like(name) and form in sure:
                confidence, kind = sure[form]
                known[name, -kind] = max(known.get((name, -kind), 0), confidence)
        for key in at_start:
            known[key] = 1.0
    out = []
    for found in every:
        spans = []
        for x in found:
            best = max((sure[f] for f in x["forms"] if f in sure), default=None)
            if x["base"]:
                continue
            if x["seed"]:
                spans.append((NAMES[x["seed"][0]], x["start"], x["end"]))
            elif best and looks_like(x["value"]):
                spans.append((NAMES[-best[1]], x["start"], x["end"]))
        out.append(spans)
    return out


def components(prints: dict[int, int], radius: int = 2) -> dict[int, int]:
    """Smallest id reachable over fingerprints within the radius."""
    parent = {i: i for i in prints}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def simhash(text: str | None) -> int:
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def quality_base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    places = {}
    for i, w in enumerate(windows):
        places.setdefault(w, []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def line_rows(text: str | None) -> list[tuple[list[float], int]]:
    """Features and words of each line with a word, one at a time."""
    out, seen = [], set()
    for line in (text or "").split("\n"):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not words:
            continue
        raw = line.encode()
        n, size = len(words), len(raw)
        marks = sum(line.count(c) for c in "#*$%&|<>")
        upper = [w for w in words if re.search("[A-Z]", w) and not re.search("[a-z]", w)]
        twice = sum(a == b for a, b in zip(words, words[1:], strict=False))
        out.append(([
            1.0, min(1.0, marks / n), len(upper) / n if n > 2 else 0.0, twice / n, max(0.0, 1 - 2.5 * len(set(words)) / n) if n > 20 else 0.0,
            min(1.0, line.count("!") / n), min(1.0, line.count("|") / n), len(re.findall("[0-9]", line)) / size, min(1.0, max(0.0, size / n - 16) / 16),
            float(line in seen), float(words[-1][-1] not in ".!?:;\""), float(n < 4),
        ], n))
        seen.add(line)
    return out


def quality_kept(text: str | None, weights: tuple, steps: tuple, share: float = 0.5) -> bool:
    """The verdict by scoring every path of labels of two lines at a time (max-product over both labels)."""
    if quality_base(text)[5]:
        return False
    rows = line_rows(text)
    scores = [sum(w * x for w, x in zip(weights, row, strict=True)) for row, _ in rows]
    best = {0: (0.0, [0]), 1: (scores[0], [1])}
    for s in scores[1:]:
        best = {y: max(((best[x][0] + steps[2 * x + y] + s * y, [*best[x][1], y]) for x in (0, 1)), key=lambda p: (p[0], -p[1][-2])) for y in (0, 1)}
    labels = max(best.values(), key=lambda p: (p[0], -p[1][-1]))[1]
    return sum(n for (_, n), y in zip(rows, labels, strict=True) if not y) >= share * sum(n for _, n in rows)
