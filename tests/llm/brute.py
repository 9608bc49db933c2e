"""Plain versions of the operators, one document after the other, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(_LOWER)


def left(doc_id, divisor):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def base_counts(text):
    text = text or ""
    words = BLANK_WORD.findall(text)
    lines = [line for line in text.split("\n") if BLANK_WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def shingle_set(text, size=3):
    words = BLANK_WORD.findall(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard_classes(docs, percent=90):
    """{position: (set size, smallest id reachable)} of [(doc_id, text)]."""
    sets = [shingle_set(text) for _, text in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in where[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            where[x].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[top(i)].append(doc_id)
    return {i: (len(sets[i]), min(ids[top(i)], default=None)) for i in range(len(docs))}


def contamination(docs, items, window=10):
    """{position: (words, hit words, sorted items)}."""
    where = defaultdict(list)
    for item, text in items:
        words = PLAIN_WORD.findall(lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            where[tuple(words[i : i + window])].append(str(item))
    lengths = sorted({len(w) for w in where})
    out = {}
    for i, (_, text) in enumerate(docs):
        words = PLAIN_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                own = where.get(tuple(words[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found.update(own)
        out[i] = (len(words), len(hit), sorted(found))
    return out


def items_digest(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def unigram_scores(docs, divisor=7, rest=2):
    """{position: (held out, tokens, known, training tokens, base score)}."""
    counts = Counter()
    tokens = []
    for doc_id, text in docs:
        words = [*BLANK_WORD.findall(lower(text)), None]
        tokens.append(words)
        if doc_id is not None and left(doc_id, divisor) != rest:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    return {
        i: (
            doc_id is None or left(doc_id, divisor) == rest,
            len(tokens[i]),
            sum(counts[w] > 0 for w in tokens[i]),
            total,
            sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens[i]),
        )
        for i, (doc_id, _) in enumerate(docs)
    }
