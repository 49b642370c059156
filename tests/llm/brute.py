"""Plain versions of the operators, from their definitions."""

import collections
import hashlib
import re
import unicodedata
import zlib

import zstandard

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def language(text, model, level, block, margin):
    """``(language, accepted, score)`` of compression with each language's raw-content dictionary."""
    plain = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())
    raw = " ".join(plain.split(" ")).encode() if plain.strip() else b""
    raw = re.sub(rb" +", b" ", raw)
    if not raw:
        return "und", False, 0.0
    sizes = []
    for rank, (name, content) in enumerate(model):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)
        sizes.append((sum(len(coder.compress(raw[a:a + block])) for a in range(0, len(raw), block)), rank, name))
    (best, _, name), (second, _, _) = sorted(sizes)[:2]
    gain = second / best - 1
    return name, second - best >= margin * best, gain / (gain + 0.05)


def shingle_set(text):
    w = SPACE_WORD.findall((text or "").translate(ASCII_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def jaccard_components(docs):
    """``{position: (size, smallest id of the component)}`` for a list of (id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low.setdefault(root(i), []).append(d)
    return [(len(sets[i]), min((d for d in low[root(i)] if d is not None), default=None)) for i in range(len(docs))]


def personal_data(text):
    """Base spans ``(kind, start, end)``."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, p in patterns.items():
        for m in re.finditer(p, text or ""):
            digits = [int(c) for c in re.sub("[^0-9]", "", m.group())]
            check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            good = {"email": lambda: True, "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda d=digits, c=check: 13 <= len(d) <= 19 and c % 10 == 0, "phone": lambda d=digits: 9 <= len(d) <= 15}
            if good[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def contamination(docs, items, span=10):
    grams = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM_WORD.findall((text or "").translate(ASCII_LOWER))
        m = min(span, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            grams[tuple(w[k:k + m])].add("" if item is None else str(item))
    lengths = {len(g) for g in grams}
    out = []
    for _, text in docs:
        w = ALNUM_WORD.findall((text or "").translate(ASCII_LOWER))
        hit, found = set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in grams:
                    hit.update(range(k, k + m))
                    found |= grams[tuple(w[k:k + m])]
        out.append((len(w), len(hit), sorted(found)))
    return out


def line_dedup(docs, min_lines, long_words):
    """Kept texts; documents are (id, text) with distinct ids."""
    first, windows = {}, []
    for d, text in sorted((x for x in docs if x[1] is not None), key=lambda x: (x[0] is not None, x[0])):
        lines = text.split("\n")
        own = [(s, min_lines) for s in range(len(lines) - min_lines + 1)]
        own += [(s, 1) for s, x in enumerate(lines) if len(SPACE_WORD.findall(x)) >= long_words]
        for s, n in own:
            key = (n, tuple(lines[s:s + n]), n == 1)
            windows.append((d, s, n, key))
            rank = (d is not None, d, s)
            if key not in first or rank < first[key]:
                first[key] = rank
    gone = {(d, s + i) for d, s, n, key in windows if first[key] != (d is not None, d, s) for i in range(n)}
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in docs}


def remove_repeats(docs, depth=50):
    first = {}
    for d, t in docs:
        raw = (t or "").encode()
        for k in range(len(raw) - depth + 1):
            w = raw[k:k + depth]
            first[w] = min(first.get(w, 1 << 62), -1 if d is None else d)
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - depth + 1):
            if first[raw[k:k + depth]] < (-1 if d is None else d):
                gone[k:k + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


def quality(text):
    w = SPACE_WORD.findall(text or "")
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    n = collections.Counter(grams)
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if SPACE_WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len({k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}))


def segment(word, pieces, longest, unknown):
    """Best path by a table over end positions: ``[(piece, id or -1)]``."""
    best = [(0.0, None, None)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            sub = word[start:end]
            if sub in pieces or end - start == 1:
                i, score = pieces.get(sub, (-1, unknown))
                total = best[start][0] + score
                if best[end] is None or total > best[end][0]:
                    best[end] = (total, start, i)
    out, at = [], len(word)
    while at:
        out.append((word[best[at][1]:at], best[at][2]))
        at = best[at][1]
    return out[::-1]
