"""Plain versions of the operators, one text at a time."""

import array
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

TO_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate(TO_LOWER)


def crc(value):
    return zlib.crc32(str(value).encode())


def simhash(rows):
    prints = {}
    for i, text in rows:
        words = SPACED.findall(lower(text))
        grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
        prints[i] = sum(1 << b for b in range(64)
                        if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    v = np.array([prints[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(v[a + 1:] ^ v[a]) <= 2):
            x, y = find(a), find(a + 1 + int(b))
            root[max(x, y)] = min(x, y)
    return {i: (f"{prints[i]:016x}", ids[find(k)]) for k, i in enumerate(ids)}


def benchmark_hits(docs, items):
    windows = defaultdict(set)
    for i, text in items:
        words = ALNUM.findall(lower(text))
        for k in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[k:k + 13])].add(str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        words, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k:k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(words), len(hit), len(found), digest,
                  bool(hit) and 20 * len(hit) >= len(words))
    return out


def token_table(docs, tokenizer):
    out, at = {}, 0
    for i, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out[i] = (at, len(ids), zlib.crc32(array.array("I", ids).tobytes()))
        at += len(ids)
    return out


_ASSIGN = re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|"
                     r"[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                     r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secret_spans(text):
    text, spans = text or "", []
    spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(spans)]


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
           "mit license": "mit"}


def license_places(text):
    words = ALNUM.findall(lower(text))
    found = [(k, label) for phrase, label in PHRASES.items()
             for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in found})))


def base_scores(docs):
    tokens = {i: SPACED.findall(lower(text)) + [None] for i, text in docs}
    counts = Counter()
    for i, words in tokens.items():
        if crc(i) % 10:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return {i: (crc(i) % 10 == 0, len(words), sum(counts[w] > 0 for w in words), n,
                sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
            for i, words in tokens.items()}


def smallest_capacity(sizes, shards):
    """The least largest sum of a cut of the sizes, in order, into so many runs."""
    def runs(capacity):
        n, at = 1, 0
        for s in sizes:
            if at + s > capacity:
                n, at = n + 1, 0
            at += s
        return n

    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if runs(mid) <= shards else (mid + 1, high)
    return low


def sainte_lague(weights, caps, seats):
    given = [0] * len(weights)
    for _ in range(seats):
        free = [i for i in range(len(weights)) if given[i] < caps[i] and weights[i] > 0]
        if not free:
            break
        best = max(free, key=lambda i: (weights[i] / (2 * given[i] + 1), -i))
        given[best] += 1
    return given


def viterbi(rows, switch):
    """Best path over rows of scores, by trying every step."""
    value, back = list(rows[0]), []
    for row in rows[1:]:
        best = max(range(len(value)), key=lambda k: (value[k], -k))
        came = [best if value[best] - switch > value[k] else k for k in range(len(value))]
        back.append(came)
        value = [max(value[k], value[best] - switch) + row[k] for k in range(len(value))]
    path = [max(range(len(value)), key=lambda k: (value[k], -k))]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1]


def _token_bytes(tokenizer, pieces):
    """Bytes of every id of a byte-level tokenizer and of a piece model."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown}
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    one = {i: bytes(back[c] for c in t) for t, i in tokenizer.get_vocab().items()}
    two = {}
    for i in range(pieces.get_piece_size()):
        p = pieces.id_to_piece(i)
        two[i] = bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
    return one, two


def alignment(docs, tokenizer, pieces):
    one, two = _token_bytes(tokenizer, pieces)
    groups = []
    for _, text in docs:
        want = (" " + (text or "")).encode()
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        made = b"".join(one[i] for i in a), b"".join(two[i] for i in b)
        found = []
        if text and made == (want, want):
            ends = [set(np.cumsum([len(t[i]) for i in ids]).tolist())
                    for ids, t in ((a, one), (b, two))]
            at, done = [0, 0], [0, 0]
            for end in sorted(ends[0] & ends[1]):
                cell = []
                for k, (ids, t) in enumerate(((a, one), (b, two))):
                    mine = []
                    while done[k] < end:
                        mine.append(ids[at[k]])
                        done[k] += len(t[ids[at[k]]])
                        at[k] += 1
                    cell.append(mine)
                found.append(cell)
        groups.append(found)
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), g, c in zip(docs, groups, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), c.total(),
                    sum(n for p, n in c.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(written.encode()).hexdigest() if g else ""))
    return out


UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle(key, text):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, z = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
    spm = h[3] % 100 < 80
    output = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return len(units), "spm" if spm else "psm", len(p), len(m), output
