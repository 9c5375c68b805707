"""The contracts of the training-data queries in plain Python, row by row, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def blank_words(text: str | None) -> list[str]:
    return BLANK_WORD.findall(text or "")


def alnum_words(text: str | None) -> list[str]:
    return ALNUM_WORD.findall(lower(text or ""))


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = blank_words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if BLANK_WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside),
        n < 10 or 100 * len(inside) > 20 * n,
    )


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
           "mit license": "mit"}


def licenses(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels."""
    words = alnum_words(text)
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        places += [
            (i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts
        ]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def conversation(turns: list[tuple[str, str]]) -> tuple:
    """n_turns, turns_sha256, loss_chars, loss_sha256."""
    loss = "".join(text for role, text in turns if role == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def url_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
             ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
             ("block", "net", "/fr/"))


def url_rule(host: str, path: str) -> tuple[str | None, str | None]:
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (max(fits)[1], max(fits)[2]) if fits else (None, None)


def crc_ids(ids) -> int:
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def shingles(text: str | None, length: int = 3) -> frozenset:
    words = BLANK_WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    n = max(1, len(words) - length + 1)
    return frozenset(tuple(words[i : i + length]) for i in range(n))


def near_components(
    texts: dict[int, str | None], length: int = 3, percent: int = 90
) -> dict[int, tuple[int, int]]:
    """doc_id → (n_shingles, component_id) with every pair compared."""
    sets = {d: shingles(t, length) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared: Counter = Counter()
    for ids in holders.values():
        ids = sorted(ids)
        shared.update((a, b) for i, a in enumerate(ids) for b in ids[i + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d)) for d in texts}


def decontaminate(texts: dict[int, str | None], items: dict[int, str | None]) -> dict[int, tuple]:
    """doc_id → (n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = defaultdict(set)
    for item, text in items.items():
        words = tuple(alnum_words(text))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows[words[i : i + 13]].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for d, text in texts.items():
        words = tuple(alnum_words(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if words[i : i + size] in windows:
                    hit.update(range(i, i + size))
                    found |= windows[words[i : i + size]]
        digest = sha(",".join(sorted(map(str, found))))
        out[d] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text: str | None) -> dict[str, list[tuple[int, int]]]:
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    tests = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [m.span() for m in rx.finditer(text) if ok(m)] for k, (rx, ok) in tests.items()}


def repeated_bytes(texts: dict[int, str | None], length: int = 200) -> dict[int, tuple]:
    """doc_id → (n_bytes, n_removed, n_spans, kept_sha256)."""
    counts: Counter = Counter()
    raw = {d: (t or "").encode() for d, t in texts.items()}
    for body in raw.values():
        counts.update(body[i : i + length] for i in range(len(body) - length + 1))
    out = {}
    for d, body in raw.items():
        removed = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if counts[body[i : i + length]] > 1:
                removed[i : i + length] = b"\x01" * length
        spans = len([x for x in bytes(removed).split(b"\0") if x])
        kept = bytes(b for b, r in zip(body, removed, strict=True) if not r)
        out[d] = (len(body), sum(removed), spans, hashlib.sha256(kept).hexdigest())
    return out
