"""Plain versions of the operators, over Python lists, as slow as they are simple."""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    n_symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered), failed


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(links, names):
    """Smallest name of each name's component."""
    parent = {n: n for n in names}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


def simhash(docs, distance=4):
    """(doc_id, text) to {doc_id: (hex fingerprint, component)}; all pairs of different fingerprints are compared."""
    prints = {d: fingerprint(t) for d, t in docs}
    first = {}
    for d in sorted(prints):
        first.setdefault(prints[d], d)
    values = np.array(list(first), dtype=np.uint64)
    links = []
    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ value) <= distance):
            links.append((first[int(value)], first[int(values[i + 1 + j])]))
    component = classes(links, first.values())
    return {d: (f"{p:016x}", component[first[p]]) for d, p in prints.items()}


def line_key(line):
    key = line.strip(BLANK).translate(LOWER)
    return key if len(key) >= 10 else None


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, kept text)}."""
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            holders[line_key(line)].add(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if line_key(x) is None or len(holders[line_key(x)]) < 2 or min(holders[line_key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def normal_tokens(text):
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def tiling(doc, item, size=5):
    """Tokens of the item covered by greedy string tiling, the longest common unmarked run first."""
    marked_d, marked_i, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while p + n < len(doc) and i + n < len(item) and doc[p + n] == item[i + n] and not marked_d[p + n] and not marked_i[i + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, i)
        n, p, i = best
        if n < size:
            return covered
        for k in range(n):
            marked_d[p + k] = marked_i[i + k] = True
        covered += n


def leaks(docs, items, size=5, coverage=0.8):
    """{(doc_id, item_id): covered tokens} of the contaminated documents."""
    at = defaultdict(set)
    token = {i: normal_tokens(t) for i, t in items}
    for i, t in token.items():
        for k in range(len(t) - size + 1):
            at[tuple(t[k : k + size])].add(i)
    out = {}
    for d, text in docs:
        t = normal_tokens(text)
        for i in {i for k in range(len(t) - size + 1) for i in at.get(tuple(t[k : k + size]), ())}:
            # only tokens in shared runs can be part of a tile; others become unequal to anything
            seeds = {tuple(token[i][k : k + size]) for k in range(len(token[i]) - size + 1)}
            keep = [False] * len(t)
            for k in range(len(t) - size + 1):
                if tuple(t[k : k + size]) in seeds:
                    keep[k : k + size] = [True] * size
            short = [x if k else None for x, k in zip(t, keep)]
            short = [x for n, x in enumerate(short) if x is not None or (n and short[n - 1] is not None)]
            found = tiling(short, token[i], size)
            if found >= coverage * len(token[i]):
                out[d, i] = found
    return out


def token_counts(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return [len(model.encode(t or "")) for t in texts]


def pieces(docs, capacity=1024):
    """{(doc_id, piece): (start, length, crc32)}."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for d, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % capacity or min(capacity, len(ids)), len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[d, n] = (a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))
    return out


def archive(pages):
    """{page_id: (bytes, digest, type, refers to)}."""
    first, out = {}, {}
    for page, html in sorted(pages, key=lambda x: x[0]):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        source = first.setdefault(digest, page)
        out[page] = (len(payload), digest, "response" if source == page else "revisit", None if source == page else source)
    return out


def conversations(turns):
    """{conv_id: (turns, digest, loss characters, loss digest)}."""
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        out[conv] = (len(rows), sha256("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(loss), sha256(loss))
    return out


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(url, rules):
    host, path = url_parts(url)
    fits = [(h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else None


def multiset(rows):
    return Counter(tuple(r) for r in rows)


def best_fit_decreasing(histogram, capacity):
    """How many sequences plain best-fit decreasing needs; the list holds the room left in each."""
    rooms = []
    for length in sorted((l for l, n in histogram.items() for _ in range(n)), reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    return len(rooms)
