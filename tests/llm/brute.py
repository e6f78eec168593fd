"""Plain Python forms of the text operators' results, and small corpora to hold them against."""

import hashlib
import random
import re
from collections import Counter

ODD_TEXTS = [None, "", " \t\n ", "one", "Ωμέγα  café\n\nЖук 漢字 🙂", "a " * 20000, "x" * 30000, "a b c d e f g h i j\n" * 3]


def corpus(seed: int, size: int = 60, vocabulary: int = 400) -> list[tuple[int, str]]:
    """Random documents with exact and near copies, shared lines and shared passages."""
    dice = random.Random(seed)
    words = ["".join(dice.choice("abcdeiourstn") for _ in range(dice.randint(2, 9))) for _ in range(vocabulary)]
    passage = " ".join(dice.choice(words) for _ in range(90))
    common = " ".join(dice.choice(words) for _ in range(9))

    def line() -> str:
        return " ".join(dice.choice(words) for _ in range(dice.randint(1, 40)))

    texts: list[str] = []
    for _ in range(size):
        kind = dice.random()
        if texts and kind < 0.15:
            texts.append(dice.choice(texts))
        elif texts and kind < 0.45:
            changed = dice.choice(texts).split(" ")
            for _ in range(dice.randint(1, 4)):
                changed[dice.randrange(len(changed))] = dice.choice(words)
            texts.append(" ".join(changed))
        else:
            lines = [line() for _ in range(dice.randint(1, 6))]
            if dice.random() < 0.4:
                lines.insert(dice.randrange(len(lines) + 1), common)
            if dice.random() < 0.3:
                lines.insert(dice.randrange(len(lines) + 1), passage + " " + line())
            texts.append("\n".join(lines))
    return list(enumerate(texts))


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words_of(text) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def shingles(words: list[str], size: int = 5) -> set:
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def similar(a: set, b: set, percent: int = 75) -> bool:
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def classes(rows) -> list[tuple]:
    """(key, number of shingles, smallest key of the class) in the order of the rows."""
    sets = [shingles(words_of(lower(t or ""))) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(key, smallest.get(find(i), key))
    return [(key, len(sets[i]), smallest.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def dedup_lines(rows) -> list[tuple]:
    """(key, lines with a word, removed lines, remaining text); rows come in document order."""
    earlier: list[set] = []
    done: dict = {}
    out = []
    for key, text in rows:
        if (key, text) in done:
            out.append(done[key, text])
            continue
        if text is None:
            done[key, text] = (key, 0, 0, None)
            out.append(done[key, text])
            continue
        kept, lines, removed = [], 0, 0
        for line in text.split("\n"):
            tokens = shingles(words_of(line))
            if tokens:
                lines += 1
                if any(similar(tokens, e) for e in earlier):
                    removed += 1
                else:
                    kept.append(line)
                earlier.append(tokens)
            else:
                kept.append(line)
        done[key, text] = (key, lines, removed, "\n".join(kept))
        out.append(done[key, text])
    return out


def contamination(rows, items, window: int = 10) -> list[tuple]:
    """(key, words, hit words, sorted item ids)."""
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    windows = []
    for item, text in items:
        words = split(text)
        size = min(window, len(words))
        if size:
            windows += [(item, tuple(words[i:i + size])) for i in range(len(words) - size + 1)]
    out = []
    for key, text in rows:
        words = split(text)
        hit, found = set(), set()
        for item, win in windows:
            for i in range(len(words) - len(win) + 1):
                if tuple(words[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    if item is not None:
                        found.add(str(item))
        out.append((key, len(words), len(hit), sorted(found)))
    return out


def repeats(rows, length: int, keep_first: bool = False) -> list[tuple]:
    """(key, bytes, removed bytes, removed runs, remaining bytes)."""
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    seen: set = set()
    done: dict = {}
    out = []
    for (key, text), d in zip(rows, data):
        if keep_first and (key, text) in done:
            out.append(done[key, text])
            continue
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            piece = d[i:i + length]
            if (piece in seen) if keep_first else count[piece] > 1:
                gone[i:i + length] = [True] * length
            seen.add(piece)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        done[key, text] = (key, len(d), sum(gone), runs, kept)
        out.append(done[key, text])
    return out


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
