"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks.

The kernel of two words sums, over all letter sequences of length three that both contain, the decay to the power of
the stretches that hold them, so ``idxiot`` and ``i-d-i-o-t`` stay near ``idiot``. The kernel of two sentences sums over
their words, so a sentence scores as the sum of its words' weights and a text as its strongest sentence. The Nystroem
map is the kernel against landmark words, whitened by the landmarks' own kernel and centred on the words of clean texts.

Training is multiple-instance on sentences: of each toxic text the strongest sentence is toxic with all its words, all
sentences of clean texts are clean, and so is each of their words alone. The strongest sentence is found by the words'
share of toxic and clean texts first and by the machine afterwards. Landmarks are the words that explain the toxic texts,
as many as the sample has; for texts that these leave unexplained, the words of the strongest sentence that lean to toxic
texts, also those of a single text; some common words; and clean words that the machine takes for toxic ones. The margin
is turned into a probability by the widest gap between the sample's texts.

Before comparison a word is lower-cased, digits and signs that stand for letters are read as letters, other characters
inside it are skipped, and runs of three or more single letters are joined to one word.

Training uses a sample of labelled texts bounded by ``rows_per_label``; neither words nor landmarks are bounded besides.
Scoring covers every whole text; its time grows with the number of landmarks.

Defined results: NULL, empty and wordless texts get the score of a text without a toxic word. Without toxic texts in
the sample all scores are 0. Repeated rows give repeated results, an empty table an empty result; columns other than
the named ones are not read.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts
from .sampling import labelled_sample

ORDER, DECAY = 3, 0.75
WINDOW = 24  # letters compared at a time; longer words are compared in overlapping windows
COMMON_LANDMARKS, HARD_LANDMARKS = 8, 4
SAME_LANDMARK = 0.5  # kernel from which on a landmark stands for a word
LEAST_GAIN = 1.2  # toxic texts not yet explained that a further witness has to explain
EXPLAINED = 0.25  # what a text counts after each of its witnesses
LEAST_LEAN = 1.0  # logarithm of toxic to clean share from which on a word of an unexplained text is a landmark
BLOCK = 64  # landmarks compared at a time
LOOKUP = 1 << 18  # letter triples, up to which a table holds them all
ROUNDS = 3
HARD_WEIGHT = 4.0  # of the strongest sentences of clean texts, against all of their sentences
RIDGE = 1e-4
POWER = 3  # of the normalised kernel, so that many slightly similar words do not add up to a toxic one
CACHE_WORDS = 400_000

FOREIGN = "\u0294"  # a letter of no word, for training on inserted characters

# Characters that stand for letters inside words.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")
_RUN = re.compile(r"[^\W\d_]{3,}")
# Every run of three single letters: three pieces of one or two characters that do not begin with two plain letters, the last
# one maybe at the end of a sentence.
_SPACED = re.compile(r"(?<!\S)(?:(?![A-Za-z]{2})\S{1,2}\s+){2}(?![A-Za-z]{2})\S{1,2}[.!?]*(?!\S)")


def plain(chunk: str) -> str:
    low = chunk.lower()
    if low.isalpha():
        return low
    core = low.strip(".,;:!?\"'()[]{}<>*#%&|~`-_+=/\\")
    if not any(c.isalpha() for c in core):
        return ""
    return "".join(c for c in core.translate(LOOKALIKES) if c.isalpha())


def readings(chunk: str) -> list[str]:
    """The forms of a text without white space that are compared: all its letters, and its runs of letters."""
    bare = chunk[:-1] if chunk[-1] in ".,;:!?" else chunk
    if len(bare) <= WINDOW and bare.isalpha() and bare.isascii():  # most of them; lower() keeps the length
        return [bare.lower()] if len(bare) >= ORDER else []
    whole = plain(chunk)
    if not whole:
        return []
    runs = [r for r in _RUN.findall(chunk.lower()) if r != whole] if not chunk.isalpha() else []
    found = []
    for word in [whole, *runs]:
        if len(word) <= WINDOW:
            found.append(word)
        else:
            found += [word[i:i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]
    return [w for w in found if len(w) >= ORDER]


def sentences_of(text: str) -> list[str]:
    """The sentences of a text; runs of single letters are read across their ends, as one more sentence each."""
    pieces = text.split()
    return _SENTENCE.split(text) + chunks_of(text)[len(pieces):]


def chunks_of(text: str) -> list[str]:
    """White-space separated pieces, with runs of single letters joined as one more piece."""
    pieces = text.split()
    single: list[str] = []
    joined: list[str] = []
    for piece in pieces:
        if len(piece) <= 2 and (letter := plain(piece)) and len(letter) == 1:
            single.append(letter)
            continue
        if len(single) >= ORDER:
            joined.append("".join(single))
        if single:
            single = []
    if len(single) >= ORDER:
        joined.append("".join(single))
    return pieces + joined


def sentence_chunks(text: str) -> list[set[str]]:
    """The different chunks of each of :func:`sentences_of`; without a run of single letters they are its pieces."""
    if _SPACED.search(text):
        return [set(chunks_of(s)) for s in sentences_of(text)]
    return [set(s.split()) for s in _SENTENCE.split(text)]


def codes(words: list[str], width: int, filler: int) -> np.ndarray:
    """Letters as numbers, one word a row; ``filler`` behind the end."""
    text = "".join([w.ljust(width, "\0") for w in words])
    out = np.frombuffer(text.encode("utf-32-le"), np.int32).reshape(len(words), width)
    return np.where(out == 0, filler, out) if filler else out


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Subsequence kernel of every row of ``left`` with every row of ``right`` (letter codes, fillers 0 and -1).

    Rows of ``right`` are taken longest first, so that the rows that reach a letter position are always the first
    ones, and all arrays have the words of ``left`` in their last dimension. What a subsequence loses hangs on the places
    of its first and last letters only, so both weigh in once and the sums between them need no decay.
    """
    lengths = (right >= 0).sum(axis=1)
    order = np.argsort(-lengths, kind="stable")
    right, lengths = right[order], lengths[order]
    words, n, m = left.shape[0], left.shape[1], int(lengths[0])
    reach = [int((lengths > b).sum()) for b in range(m)]  # rows with a letter at a position
    edges = np.concatenate(([0], np.cumsum(reach)))
    letters = np.unique(right[right >= 0])
    weight = np.zeros((int(edges[-1]), len(letters) + 1), np.float32)  # the last column is for all other letters
    for b in range(m):
        place = np.searchsorted(letters, right[:reach[b], b])
        weight[edges[b] + np.arange(reach[b]), place] = 1.0
    index = np.searchsorted(letters, left)
    index[index == len(letters)] = 0
    index = np.where(letters[index] == left, index, len(letters))
    tails = [np.zeros((m + 1, right.shape[0], words), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros((right.shape[0], words), np.float32)
    step, part = np.empty_like(total), np.empty_like(total)
    for a in range(n):
        same = weight[:, index[:, a]]
        for b in range(m):
            rows = slice(reach[b])
            np.multiply(same[edges[b]:edges[b + 1]], tails[-1][b, rows], out=part[rows])
            part[rows] *= DECAY ** (a + b + 2)
            total[rows] += part[rows]
        for i in range(ORDER - 1, 0, -1):  # highest order first: each reads the one below as it was
            step.fill(0.0)
            for b in range(m):
                rows, match = slice(reach[b]), same[edges[b]:edges[b + 1]]
                now = step[rows]
                np.multiply(match, DECAY ** -(a + b) if i == 1 else tails[i - 2][b, rows], out=part[rows])
                now += part[rows]
                tails[i - 1][b + 1, rows] += now
    out = np.empty((words, right.shape[0]), np.float32)
    out[:, order] = total.T
    return out


def self_kernel(left: np.ndarray) -> np.ndarray:
    """Kernel of every row of ``left`` with itself."""
    rows, n = left.shape
    tails = [np.zeros((n + 1, rows), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(rows, np.float32)
    turned = np.ascontiguousarray(left.T)
    for a in range(n):
        same = ((turned == turned[a]) & (turned > 0)).astype(np.float32) * (DECAY * DECAY)
        total += (same * tails[-1][:-1]).sum(axis=0)
        for i in range(ORDER - 1, 0, -1):
            gained = same if i == 1 else same * tails[i - 2][:-1]
            step = np.zeros(rows, np.float32)
            for b in range(n):
                step *= DECAY
                step += gained[b]
                tails[i - 1][b + 1] *= DECAY
                tails[i - 1][b + 1] += step
    return total


class TripleTable:
    """The same kernel of words with landmarks as a sum over the landmarks' letter triples, for many words.

    A landmark is the sum of its triples of letters, each with the decay of its stretch. A word's triples are looked up, and only
    those that a landmark has are added up: few letters of two words are the same.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.letters = np.array(sorted({ord(c) for w in landmarks for c in w}), np.int64)
        self.base = len(self.letters) + 1  # the last one is for all other letters
        self.places: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.blocks = [self._block(landmarks[i:i + BLOCK]) for i in range(0, len(landmarks), BLOCK)]

    def _of_width(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of all triples in a word and their decay."""
        if width not in self.places:
            at = np.array(list(itertools.combinations(range(width), ORDER)), np.int64)
            self.places[width] = at, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32)
        return self.places[width]

    def _numbers(self, left: np.ndarray) -> np.ndarray:
        """The triples of every row of letter codes, as numbers."""
        place = np.minimum(np.searchsorted(self.letters, left), self.base - 2)
        place = np.where(self.letters[place] == left, place, self.base - 1)
        at, _ = self._of_width(left.shape[1])
        return (place[:, at[:, 0]] * self.base + place[:, at[:, 1]]) * self.base + place[:, at[:, 2]]

    def _block(self, landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sorted triples of some landmarks, and what each adds to each of them."""
        found = [(self._numbers(codes([w], len(w), 0))[0], self._of_width(len(w))[1]) for w in landmarks]
        triples = np.unique(np.concatenate([numbers for numbers, _ in found]))
        values = np.zeros((len(landmarks), len(triples)), np.float32)
        for i, (numbers, decay) in enumerate(found):
            np.add.at(values[i], np.searchsorted(triples, numbers), decay)
        return triples, values

    def kernel(self, left: np.ndarray) -> np.ndarray:
        """Kernel of every row of ``left`` (letter codes, filler 0) with every landmark."""
        numbers, (_, decay) = self._numbers(left), self._of_width(left.shape[1])
        out = np.zeros((len(left), len(self.landmarks)), np.float32)
        for i, (triples, values) in enumerate(self.blocks):
            part = slice(i * BLOCK, i * BLOCK + len(values))
            if self.base ** ORDER <= LOOKUP:  # a table of all triples, else a search among those that are there
                row = np.full(self.base ** ORDER, -1, np.int32)
                row[triples] = np.arange(len(triples))
                row = row[numbers]
            else:
                row = np.minimum(np.searchsorted(triples, numbers), len(triples) - 1)
                row = np.where(triples[row] == numbers, row, -1)
            word, place = np.nonzero(row >= 0)
            if not len(word):
                continue
            first = np.flatnonzero(np.diff(word, prepend=-1))
            added = np.take(values, row[word, place], axis=1)
            added *= decay[place]
            out[word[first], part] = np.add.reduceat(added, first, axis=1).T
        return out


class SubsequenceMachine:
    """Word scores: landmarks, whitening and weights in one vector of landmark weights."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        width = max(map(len, landmarks))
        self.right = codes(landmarks, width, -1)
        self.own = self_kernel(codes(landmarks, width, 0))
        between = (kernel(codes(landmarks, width, 0), self.right) / np.sqrt(np.outer(self.own, self.own))) ** POWER
        values, vectors = np.linalg.eigh(between.astype(np.float64) + 1e-6 * np.eye(len(landmarks)))
        self.whitening = (vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        self.weights, self.shift, self.bias = np.zeros(len(landmarks)), 0.0, 0.0

    def similar(self, words: list[str], triples: TripleTable | None = None) -> np.ndarray:
        """Normalised kernel of words (at most WINDOW letters) with the landmarks; with their table, if there is one."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 512):
            rows = order[at:at + 512]
            left = codes([words[i] for i in rows], len(words[rows[-1]]), 0)
            if triples is not None:
                out[rows] = triples.kernel(left)
            else:
                for first in range(0, len(self.landmarks), BLOCK):
                    part = slice(first, first + BLOCK)
                    out[rows, part] = kernel(left, self.right[part])
            out[rows] = (out[rows] / np.sqrt(np.maximum(np.outer(self_kernel(left), self.own), 1e-12))) ** POWER
        return out

    def features(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Nystroem features of words, centred on their mean by ``counts``."""
        found = self.similar(words).astype(np.float32) @ self.whitening.astype(np.float32)
        self.centre = (counts @ found) / max(1e-9, counts.sum())
        return found - self.centre.astype(np.float32)

    def fit(self, rows: np.ndarray, labels: np.ndarray, cost: np.ndarray, rounds: int = 30) -> None:
        """Squared-hinge linear machine on sentence features by Newton steps."""
        rows = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
        signs = np.where(labels > 0, 1.0, -1.0)
        ridge = np.append(np.full(rows.shape[1] - 1, RIDGE), 1e-9)

        def loss(at: np.ndarray) -> float:
            return float((cost * np.maximum(0.0, 1.0 - signs * (rows @ at)) ** 2).sum() + (ridge * at * at).sum())

        now = np.zeros(rows.shape[1])
        value = loss(now)
        for _ in range(rounds):
            gap = 1.0 - signs * (rows @ now)
            active = gap > 0
            inside = rows[active].astype(np.float64)
            slope = -(inside * (cost * signs * gap)[active][:, None]).sum(axis=0) + ridge * now
            bend = (inside * cost[active][:, None]).T @ inside + np.diag(ridge)
            step, size = np.linalg.solve(bend, slope), 1.0
            while size > 1e-3 and (after := loss(now - size * step)) > value:
                size /= 2
            if size <= 1e-3 or value - after < 1e-7 * value:
                break
            now, value = now - size * step, after
        self.weights = self.whitening @ now[:-1]
        self.shift, self.bias = float(self.centre @ now[:-1]), float(now[-1])

    def margins(self, words: list[str], triples: TripleTable | None = None) -> np.ndarray:
        """What each word adds to the score of a sentence, which begins at ``bias``."""
        return self.similar(words, triples) @ self.weights - self.shift


class ToxicityModel:
    """Text scores; ``machine`` is None when the sample had no toxic text to learn from."""

    def __init__(self, samples: list[tuple[int, str]]):
        self.machine: SubsequenceMachine | None = None
        self.slope, self.offset = 1.0, 0.0
        bags = [(int(label), [set(w) for s in sentences_of(text) if (w := self._words(s))]) for label, text in samples]
        bags = [(label, sentences) for label, sentences in bags if sentences]
        texts = [(label, set().union(*sentences)) for label, sentences in bags]
        toxic = [at for at, (label, _) in enumerate(bags) if label == 1]
        if not toxic:
            return
        every = sorted(set().union(*[words for _, words in texts]))
        number = {w: i for i, w in enumerate(every)}
        seen = {kind: Counter(w for label, words in texts if label == kind for w in words) for kind in (0, 1)}
        clean_texts = max(1, len(bags) - len(toxic))
        least = 0.5 / min(len(toxic), clean_texts)
        lean = {w: float(np.log((n / len(toxic) + least) / (seen[0][w] / clean_texts + least))) for w, n in seen[1].items()}

        # Sentences as word numbers, text by text.
        flat, starts, owner = [], [], []
        for at, (_, sentences) in enumerate(bags):
            for words in sentences:
                starts.append(len(flat))
                flat += sorted(number[w] for w in words)
                owner.append(at)
        flat, starts, owner = np.array(flat), np.array(starts), np.array(owner)
        first = np.searchsorted(owner, np.arange(len(bags) + 1))
        clean = np.array([label == 0 for label, _ in bags])[owner]

        def strongest(value: np.ndarray, texts: list[int]) -> np.ndarray:
            """The strongest sentence of each of some texts, when words add ``value``."""
            sums = np.add.reduceat(value[flat], starts)
            return np.array([first[at] + int(sums[first[at]:first[at + 1]].argmax()) for at in texts], np.int64)

        chosen = strongest(np.array([max(0.0, lean.get(w, 0.0) - LEAST_LEAN / 2) for w in every]), toxic)
        rare: list[str] = []
        witnesses = self._witnesses(texts)
        common = [w for w, _ in sorted(seen[0].items(), key=lambda x: (-x[1], x[0]))]
        short = [w for w in common if len(w) <= 8]
        spread = short[::max(1, len(short) // COMMON_LANDMARKS)][:COMMON_LANDMARKS]
        # Without shared toxic words and short clean ones, the words of the toxic texts themselves.
        first_words = [*witnesses, *spread] or sorted(seen[1], key=lambda w: (-lean[w], w))
        landmarks = self._landmarks(first_words)
        own = list(witnesses)  # words taken for toxic alone
        hard = np.zeros(0, np.int64)
        for round_ in range(ROUNDS):
            spoilt: dict[str, float] = {}  # also with a foreign letter inside
            for word in own:
                spoilt[word] = seen[1][word]
                for at in range(1, len(word)):
                    spoilt[word[:at] + FOREIGN + word[at:]] = 0.25 * seen[1][word] / len(word)
            words = [*every, *(w for w in spoilt if w not in number)]
            place = {w: i for i, w in enumerate(words)}
            counts = np.array([1.0 * seen[0][w] for w in words])
            alone = np.array([place[w] for w in common], np.int64)
            self.machine = SubsequenceMachine(landmarks)
            features = self.machine.features(words, counts)
            used = np.concatenate([chosen, np.flatnonzero(clean)])
            sums = self._sums(features, flat, np.append(starts, len(flat)), used)
            single = features[[place[w] for w in spoilt]].reshape(len(spoilt), features.shape[1])
            rows = np.concatenate([sums, single, features[alone]])
            every_clean = np.ones(len(clean))
            every_clean[hard] += HARD_WEIGHT * clean.sum() / max(1, len(hard))
            weights = [np.ones(len(chosen)), every_clean[clean], np.array([*spoilt.values()]), 1.0 + 0.2 * counts[alone]]
            cost = np.concatenate([w / max(1e-9, w.sum()) for w in weights])
            labels = np.repeat([1, 0, 1, 0], [len(w) for w in weights])
            self.machine.fit(rows, labels, cost)
            value = self.machine.margins(every)
            best = strongest(value, toxic)
            hard = strongest(value, [at for at, (label, _) in enumerate(bags) if label == 0])
            if round_ == 0:  # words of the texts that the machine leaves unexplained
                sums = np.add.reduceat(value[flat], starts)
                for at, sentence, first_choice in zip(toxic, best, chosen):
                    if sums[sentence] + self.machine.bias <= 0:
                        found = sorted(bags[at][1][first_choice - first[at]], key=lambda w: (-lean[w], w))
                        rare += [w for i, w in enumerate(found) if lean[w] >= LEAST_LEAN or i == 0]
                landmarks = self._landmarks([*landmarks, *rare])
                own += [w for w in dict.fromkeys(rare) if w not in own and not seen[0][w]]
            else:
                chosen = best
            taken = set(landmarks)
            score = {w: self.machine.bias + value[number[w]] for w in common}
            near = sorted((w for w in common if score[w] > 0 and w not in taken), key=lambda w: (-score[w], w))
            if round_ < ROUNDS - 1 and near:
                landmarks = [*landmarks, *self._landmarks(near[:40])[:HARD_LANDMARKS]]
        tops = np.maximum.reduceat(np.add.reduceat(value[flat], starts), first[:-1]) + self.machine.bias
        self._calibrate(tops, np.array([label for label, _ in bags]))

    @staticmethod
    def _sums(features: np.ndarray, flat: np.ndarray, edges: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Summed word features of the sentences ``used``."""
        return np.array([features[flat[edges[i]:edges[i + 1]]].sum(axis=0) for i in used]).reshape(len(used), -1)

    @staticmethod
    def _words(sentence: str) -> list[str]:
        return [r for chunk in chunks_of(sentence) for r in readings(chunk)]

    @staticmethod
    def _witnesses(bags: list[tuple[int, set[str]]]) -> list[str]:
        """Words that between them explain the toxic texts. A text counts a quarter with each witness it has, so the
        many words that copies of one toxic text share do not follow its first witnesses."""
        clean = Counter(w for label, bag in bags if label == 0 for w in bag)
        holders: dict[str, set[int]] = defaultdict(set)
        for at, (label, bag) in enumerate(bags):
            if label == 1:
                for word in bag:
                    holders[word].add(at)
        toxic = sum(label == 1 for label, _ in bags)
        clean_texts = max(1, sum(label == 0 for label, _ in bags))
        open_words = {w: s for w, s in holders.items()
                      if len(s) >= 2 and len(s) / max(1, toxic) > 8 * clean[w] / clean_texts}
        gain = {w: float(len(s)) for w, s in open_words.items()}
        weight = np.ones(len(bags))
        found: list[str] = []
        queue = [(-g, w) for w, g in gain.items()]
        heapq.heapify(queue)
        while queue:  # gains only fall: a word whose gain is still that of the queue is the best
            old, word = heapq.heappop(queue)
            now = float(weight[list(open_words[word])].sum())
            if now < LEAST_GAIN:
                continue
            if now < -old:
                heapq.heappush(queue, (-now, word))
                continue
            found.append(word)
            weight[list(open_words[word])] *= EXPLAINED
        return found

    @staticmethod
    def _landmarks(words: list[str]) -> list[str]:
        """The words, without those that an earlier one stands for."""
        words = list(dict.fromkeys(words))
        width = max(map(len, words))
        own = self_kernel(codes(words, width, 0))
        near = kernel(codes(words, width, 0), codes(words, width, -1)) / np.sqrt(np.maximum(np.outer(own, own), 1e-12))
        chosen: list[int] = []
        for i in range(len(words)):
            if not chosen or near[i, chosen].max() < SAME_LANDMARK:
                chosen.append(i)
        return [words[i] for i in chosen]

    def _calibrate(self, tops: np.ndarray, labels: np.ndarray) -> None:
        """The margin of probability one half: where the sample's texts are told apart with the fewest errors, in the
        widest such gap."""
        order = np.argsort(tops, kind="stable")
        tops, labels = tops[order], labels[order]
        toxic, clean = max(1, (labels == 1).sum()), max(1, (labels == 0).sum())
        missed = np.concatenate(([0], np.cumsum(labels == 1))) / toxic  # toxic texts below a cut
        caught = 1 - np.concatenate(([0], np.cumsum(labels == 0))) / clean  # clean texts above it
        edges = np.concatenate(([tops[0] - 1], tops, [tops[-1] + 1]))
        gaps = np.diff(edges)
        errors = np.round(missed + caught, 9)
        cut = max(range(len(gaps)), key=lambda i: (-errors[i], gaps[i]))
        middle = np.clip(0.0, edges[cut] + 0.25 * gaps[cut], edges[cut] + 0.6 * gaps[cut])  # the machine's own, if there
        self.slope = float(np.clip(4 / max(gaps[cut], 1e-6), 3.0, 12.0))
        self.offset = -self.slope * float(middle)

    def probability(self, tops: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * tops + self.offset, -30, 30)))


class TextScorer:
    """Scores whole texts, with word margins remembered for a task."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.triples = TripleTable(model.machine.landmarks) if model.machine is not None else None
        self.margin: dict[str, float] = {}  # of texts without white space
        self.value: dict[str, float] = {}  # of their readings

    def _learn(self, chunks: set[str]) -> None:
        forms = {c: readings(c) for c in chunks}
        value = self.value
        words = sorted({w for f in forms.values() for w in f}.difference(value))
        if words:
            value.update(zip(words, self.model.machine.margins(words, self.triples).tolist()))
        for chunk, found in forms.items():
            self.margin[chunk] = max([value[w] for w in found], default=0.0)

    def __call__(self, texts: list[str | None]) -> dict[str, list]:
        if self.model.machine is None:
            return {"score": [0.0] * len(texts)}
        if len(self.margin) > CACHE_WORDS:
            self.margin, self.value = {}, {}
        split = [sentence_chunks(t or "") for t in texts]
        fresh = set().union(*[s for sentences in split for s in sentences]).difference(self.margin)
        if fresh:
            self._learn(fresh)
        get, bias = self.margin.__getitem__, self.model.machine.bias
        # Sums do not hang on the order of a set, so that equal texts score the same in every process.
        tops = np.array([bias + max((math.fsum(map(get, s)) for s in sentences), default=0.0) for sentences in split])
        return {"score": self.model.probability(tops).tolist()}


def train(
    docs: DataFrame, labels: DataFrame | None = None, text: str = "text", label: str = "toxic", key: str = "doc_id",
    rows_per_label: int = 1000,
) -> ToxicityModel:
    """A model from at most ``rows_per_label`` texts of each label (0 and 1), which is a column of ``docs`` or of
    ``labels``."""
    return ToxicityModel(labelled_sample(docs, text, label, rows_per_label, labels, key))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) for every row."""
    return map_texts(docs, keep, text, lambda: TextScorer(model), {"score": pa.float64()}, rows=2048)
