"""Small brute-force versions the operators are tested against."""

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def license_base(text):
    w = words(text)
    places = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"),
                                               ("general public license", "gpl"))
              for p in [phrase.split()] for i in range(len(w)) if w[i:i + len(p)] == p]
    return (len(w), len(places), min((p[0] for p in places), default=None),
            max((p[0] for p in places), default=None), ",".join(sorted({p[1] for p in places})))


def contamination(text, items, window=13):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        q = words(item)
        n = min(window, len(q))
        grams = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                names.add(str(name))
    return (len(w), len(hit), len(names), sha(",".join(sorted(names))),
            len(hit) > 0 and 20 * len(hit) >= len(w))


def quality(text):
    text = text or ""
    w = BLANK_WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    repeated = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            repeated.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if BLANK_WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated),
            len(w) < 10 or 100 * len(repeated) > 20 * len(w))


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(text):
    """(start, kind number, end, kind) of every base span, sorted."""
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255
                    or kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def repeats(texts, size=200):
    """(n_bytes, n_removed, n_spans, kept sha) of every text."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for i in range(len(t) - size + 1):
            seen[t[i:i + size]] = seen.get(t[i:i + size], 0) + 1
    out = []
    for t in raw:
        cut = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                cut[i:i + size] = b"\1" * size
        kept = bytes(b for b, c in zip(t, cut) if not c)
        spans = len([x for x in bytes(cut).split(b"\0") if x])
        out.append((len(t), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return out


def bag(text):
    from collections import Counter
    w = words(text)
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else Counter()


def similarity(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low)


def near_classes(rows, limit=0.8):
    """Position -> set of positions of its class, over (id, text) rows."""
    bags = [bag(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                a, b = sum(bags[i].values()), sum(bags[j].values())
                if min(a, b) >= limit * max(a, b) and similarity(bags[i], bags[j]) >= limit:
                    group[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]
