"""Plain versions of the operators, over lists of (doc_id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BLANKS = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, size=35):
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    starts = Counter(tuple(w[k : k + size]) for _, w in split for k in range(len(w) - size + 1))
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            if starts[tuple(words[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        yield i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))


def quality(rows):
    for i, text in rows:
        text = text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        again = [False] * len(words)
        for k in range(len(words) - 4):
            if windows[tuple(words[k : k + 5])] > 1:
                again[k : k + 5] = [True] * 5
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        yield i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), sum(again)


def shared_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: low(line.strip(BLANKS))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    for i, text in rows:
        lines = (text or "").split("\n")
        last = lambda k: max((x for x in holders[k] if x is not None), default=None)
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or len(key(x)) < min_chars or last(key(x)) == i]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


def passages(rows, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall(low(text))
        n = min(size, len(words))
        for k in range(len(words) - n + 1) if n else ():
            windows[tuple(words[k : k + n])].add(item)
    sizes = {len(w) for w in windows}
    for i, text in rows:
        words, found = ITEM_WORD.findall(low(text)), set()
        hit = [False] * len(words)
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit[k : k + n] = [True] * n
                    found |= windows[tuple(words[k : k + n])]
        yield i, len(words), sum(hit), sorted(str(x) for x in found if x is not None), any(hit)


def groups(rows):
    sets = {}
    for i, text in rows:
        words = WORD.findall(low(text))
        runs = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
        sets.setdefault((i, runs))
    keys = [k for k in sets if k[0] is not None]
    part = {i: i for i, _ in keys}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            both = len(keys[a][1] & keys[b][1])
            if both and 100 * both >= 80 * len(keys[a][1] | keys[b][1]):
                x, y = find(keys[a][0]), find(keys[b][0])
                part[max(x, y)] = min(x, y)
    for i, text in rows:
        words = WORD.findall(low(text))
        size = len({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}) if words else 0
        yield i, size, None if i is None else find(i)


def katz(rows, train, kept_words, kept_pairs):
    """Scores with the given shares of counts 1 to 5 that are kept."""
    texts = [(i, WORD.findall(low(t)) + [None]) for i, t in rows]
    words, pairs, histories = Counter(), Counter(), Counter()
    for (_, tokens), learn in zip(texts, train):
        if learn:
            words.update(tokens)
            for a, b in zip(["<start>", *tokens], tokens):
                pairs[a, b] += 1
                histories[a] += 1
    total, distinct = sum(words.values()), len(words)
    keep = lambda kept, n: n * (kept[n] if n <= 5 else 1)
    mass = sum(keep(kept_words, n) for n in words.values())
    divisor = max(1, total if mass < total - 1e-9 else total + 1)
    one = lambda w: keep(kept_words, words[w]) / divisor if w in words else 1 - mass / divisor
    after = defaultdict(list)
    for (a, b), n in pairs.items():
        after[a].append((b, n))
    weights = {}
    for a, found in after.items():
        held = sum(keep(kept_pairs, n) for _, n in found)
        below = histories[a] if held < histories[a] - 1e-9 else histories[a] + 1
        weights[a] = below, (1 - held / below) / (1 - sum(one(b) for b, _ in found))

    def two(a, b):
        if (a, b) in pairs:
            return keep(kept_pairs, pairs[a, b]) / weights[a][0]
        return (weights[a][1] if a in weights else 1) * one(b)

    scores = []
    for i, tokens in texts:
        score = sum(math.log10(two(a, b)) for a, b in zip(["<start>", *tokens], tokens))
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        scores.append((i, len(tokens), sum(w in words for w in tokens), total, base, score))
    return scores, words, two, after


def crc(i, of):
    return None if i is None else zlib.crc32(str(i).encode()) % of
