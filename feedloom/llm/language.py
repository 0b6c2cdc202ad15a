"""Language of texts, word by word: a linear-chain conditional random field.

Words are labelled with languages by affix, character n-gram and lexicon features and learned transitions. The marginals of
the forward-backward algorithm say how likely each word is in each language, also where a text changes between
languages; their sum over the words with a letter gives the language of the text.

The model is fitted on a bounded sample: about ``SAMPLE`` labelled documents per language, chosen by a hash of
the id, and ``WINDOW`` words from a place in each chosen by the same hash. Its sequences join pieces from documents of different
languages, so that the transitions learn to switch. Everything else covers all rows and whole texts.

Shares add up to one over the learned languages, so they cannot tell a text in none of them. For that every word has a
proof: the mean log frequency of its features in the language where it stands out least, against that language's own
words in documents left out of the count. ``keep_spoken`` wants the mean proof of a text to be no lower than that of the
training documents by ``SPREADS`` standard deviations, for as many different words as the text has.

Edge cases: a null text, and one without a letter, is ``und`` with score 0; words without a letter have no
features of their own and take no part in the score; null labels are not learned; without any labelled text all
texts are ``und``; repeated rows and ties give equal rows, and of equal sums the label first by name wins.
"""

from __future__ import annotations

import pickle
import zlib
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ascii_words, few, run_batches, stored

SAMPLE = 1200
WINDOW = 90
FEATURES = 1 << 16
LEXICON = 400
EPOCHS = 6
BATCH_WORDS = 1 << 17
MEMORY = 1 << 18
NEW_WORDS = 1 << 12
PIECE = 512
MARGIN = 48
SPREADS = 5.5
WORD_SPREADS = 3.0


class Names(dict):
    """Names of features to their numbers, remembered up to ``MEMORY`` of them: most words share theirs."""

    def __missing__(self, name: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        number = self[name] = zlib.crc32(name.encode("utf-8", "replace")) % FEATURES
        return number


NUMBERS = Names()


def features(word: str, lexicon: dict[str, list[int]]) -> list[int]:
    """Hashed features of a word: affixes, character n-grams with borders, lexicon entries; none without a letter."""
    letters = word.lower()
    if not letters.isalpha():
        letters = "".join(filter(str.isalpha, letters))
        if not letters:
            return []
    edged = f"^{letters}$"
    names = [f"p{letters[:n]}" for n in (1, 2, 3)] + [f"s{letters[-n:]}" for n in (1, 2, 3, 4)]
    names += [edged[i : i + n] for n in (2, 3) for i in range(len(edged) - n + 1)]
    found = list(map(NUMBERS.__getitem__, names))
    return found + [FEATURES + x for x in lexicon[letters]] if letters in lexicon else found


class Chain:
    """A fitted model: ``labels``, ``lexicon``, feature weights and transitions; feature proofs and their spread in documents."""

    def __init__(self, labels: list[str], lexicon: dict[str, list[int]], weights: np.ndarray, steps: np.ndarray, first: np.ndarray,
                 proofs: np.ndarray | None = None, spread: tuple[float, float, float] = (0.0, 0.0, 0.0)):
        self.labels, self.lexicon, self.weights, self.steps, self.first = labels, lexicon, weights, steps, first
        self.proofs, self.spread = proofs, spread

    def parts(self, proofs: bool = True) -> tuple:
        """Plain values, which a broadcast can carry to workers that have not loaded this module yet."""
        return (self.labels, self.lexicon, self.weights, self.steps, self.first) + ((self.proofs, self.spread) if proofs else ())

    def width(self) -> int:
        return len(self.labels) + 1 + (self.proofs is not None)

    def least_proof(self, words: int) -> float:
        """The least mean proof of a text with so many different words in a learned language."""
        usual, between, within = self.spread
        return usual - SPREADS * np.sqrt(between**2 + within**2 / words)

    def emissions(self, words: list[str]) -> np.ndarray:
        """One row per word: label scores, then 1 if the word has a letter, then its proof if the model has proofs.

        Scores are divided by the root of the number of features, so long words do not drown the chain.
        """
        listed = [features(word, self.lexicon) for word in words]
        labels = len(self.labels)
        out = np.zeros((len(words), self.width()))
        rows = np.flatnonzero([bool(x) for x in listed])
        if len(rows):
            sizes = np.array([len(listed[i]) for i in rows])
            flat = np.fromiter(chain.from_iterable(listed), np.int64, int(sizes.sum()))
            starts = np.cumsum(sizes) - sizes
            out[rows, :labels] = np.add.reduceat(self.weights[flat], starts) / np.sqrt(sizes)[:, None]
            out[rows, labels] = 1
            if self.proofs is not None:
                # One key or number among words says little: no word is further off than this.
                floor = self.spread[0] - WORD_SPREADS * self.spread[2]
                out[rows, -1] = np.maximum((np.add.reduceat(self.proofs[flat], starts) / sizes[:, None]).max(1), floor)
        return out


class Known(dict):
    """Words to numbers, with the emissions of all words numbered so far."""

    def __init__(self, model: Chain):
        super().__init__()
        self.model, self.new, self.table = model, [], np.zeros((0, model.width()))

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word.decode("utf-8", "replace"))
        return number

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self) > MEMORY:
            self.clear()
            self.new, self.table = [], self.table[:0]
        found = []
        for text in texts:
            # The words of one text at a time: they take ten times the room of their numbers.
            words = ascii_words(text)
            found.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        if self.new:
            # A few words at a time: their features are lists.
            parts = [self.model.emissions(self.new[i : i + NEW_WORDS]) for i in range(0, len(self.new), NEW_WORDS)]
            self.table = np.concatenate([self.table, *parts])
            self.new = []
        return found


def marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray, first: np.ndarray):
    """Forward-backward over sequences laid out by time: ``scores[i, t]`` of sequence i, longest first.

    Returns the marginals and the forward and backward vectors, normalised at each step.
    """
    count, longest, labels = scores.shape
    move = np.exp(steps)
    local = np.exp(scores - scores.max(2, keepdims=True))
    ahead, back = np.zeros_like(local), np.ones_like(local)
    active = [int((lengths > t).sum()) for t in range(longest)]
    ahead[:, 0] = local[:, 0] * np.exp(first)
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for t in range(1, longest):
        n = active[t]
        now = (ahead[:n, t - 1] @ move) * local[:n, t]
        ahead[:n, t] = now / now.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        now = (back[:n, t + 1] * local[:n, t + 1]) @ move.T
        back[:n, t] = now / now.sum(1, keepdims=True)
    both = ahead * back
    return both / np.maximum(both.sum(2, keepdims=True), 1e-300), ahead, back * local


def prove(pieces: list[tuple[int, list[str]]], lexicon: dict[str, list[int]], labels: int) -> tuple[np.ndarray, tuple[float, float, float]]:
    """Proofs of the features, and the mean proof, its deviation between documents and that of words, without each document's own counts."""
    counts, listed = np.zeros((FEATURES + labels, labels)), {}
    documents = []
    for label, words in pieces:
        own = []
        for word in words:
            if word not in listed:
                listed[word] = np.array(features(word, lexicon), np.int32)
            if len(listed[word]):
                own.append(listed[word])
        if own:
            documents.append((label, own))
            counts[:, label] += np.bincount(np.concatenate(own), minlength=len(counts))
    totals = counts.sum(0) + 0.5 * len(counts)
    proofs = np.log((counts + 0.5) / totals)
    scored = []
    for label, own in documents:
        flat, sizes = np.concatenate(own), np.array([len(x) for x in own])
        starts, found = np.cumsum(sizes) - sizes, proofs[flat]
        names, place, mine = np.unique(flat, return_inverse=True, return_counts=True)
        found[:, label] = np.log((counts[names, label] - mine + 0.5) / (totals[label] - len(flat)))[place]
        scored.append((label, np.add.reduceat(found, starts) / sizes[:, None]))
    usual = np.zeros(labels)
    for label in range(labels):
        own = [x[:, label].mean() for y, x in scored if y == label]
        usual[label] = np.median(own) if own else 0.0
    # Medians and quantiles: some labelled documents are junk.
    words = [(x - usual).max(1) for _, x in scored]
    if not words:
        return proofs - usual, (0.0, 0.0, 0.0)
    means = np.array([x.mean() for x in words])
    within = float(np.sqrt(np.median([x.var() for x in words if len(x) > 1] or [0.0])))
    middle = float(np.median(means))
    # Half of those below the middle of a normal distribution are more than 0.6745 deviations off.
    off = middle - means[means < middle]
    between = float(np.median(off) / 0.6745) if len(off) else 0.0
    return proofs - usual, (middle, between, within)


def fit(sample: pd.DataFrame, epochs: int = EPOCHS, seed: int = 7) -> Chain | None:
    """Fit on rows ``text, lang`` by adaptive gradient steps on the log likelihood of the label sequences."""
    sample = sample.sort_values(["lang", "text"])
    labels = sorted(sample["lang"].unique())
    if not labels:
        return None
    random = np.random.default_rng(seed)
    place = {x: i for i, x in enumerate(labels)}
    pieces = [(place[lang], [w.decode("utf-8", "replace") for w in ascii_words(text)]) for text, lang in zip(sample["text"], sample["lang"])]
    pieces = [(label, words) for label, words in pieces if words]
    # Lexicon: the most frequent words of each label.
    lexicon: dict[str, list[int]] = {}
    for label in range(len(labels)):
        counts: dict[str, int] = {}
        for own, words in pieces:
            if own == label:
                for w in words:
                    w = "".join(c for c in w.lower() if c.isalpha())
                    if w:
                        counts[w] = counts.get(w, 0) + 1
        for w, k in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            if k > 1:
                lexicon.setdefault(w, []).append(label)
    proofs, spread = prove(pieces, lexicon, len(labels))
    # Sequences of one to three parts from different documents.
    parts = []
    for label, words in pieces:
        at = 0
        while at < len(words):
            n = int(random.integers(8, 46))
            parts.append((label, words[at : at + n]))
            at += n
    parts = [parts[i] for i in random.permutation(len(parts))]
    sequences, at = [], 0
    known: dict[str, int] = {}
    while at < len(parts):
        n = int(random.integers(1, 4))
        own = [(known.setdefault(w, len(known)), label) for label, words in parts[at : at + n] for w in words]
        sequences.append(np.array(own, np.int32))
        at += n
    listed = [np.array(features(w, lexicon), np.int32) for w in known]
    width = max((len(x) for x in listed), default=0)
    nothing = FEATURES + len(labels)
    table = np.full((len(known), width), nothing, np.int32)
    for i, x in enumerate(listed):
        table[i, : len(x)] = x
    scale = np.array([1 / np.sqrt(len(x)) if len(x) else 0.0 for x in listed])
    del listed, parts, pieces
    k = len(labels)
    weights, steps, first = np.zeros((nothing + 1, k)), np.zeros((k, k)), np.zeros(k)
    sums = [np.full_like(x, 1e-8) for x in (weights, steps, first)]
    for _ in range(epochs):
        order = random.permutation(len(sequences))
        for begin in range(0, len(order), 64):
            batch = sorted((sequences[i] for i in order[begin : begin + 64]), key=len, reverse=True)
            lengths = np.array([len(x) for x in batch])
            words, truth = np.zeros((len(batch), lengths[0]), int), np.zeros((len(batch), lengths[0]), int)
            for i, x in enumerate(batch):
                words[i, : len(x)], truth[i, : len(x)] = x[:, 0], x[:, 1]
            mask = np.arange(lengths[0])[None] < lengths[:, None]
            scores = weights[table[words]].sum(2) * scale[words][:, :, None]
            found, ahead, back = marginals(scores, lengths, steps, first)
            wanted = np.eye(k)[truth]
            gap = (wanted - found) * mask[:, :, None]
            pair = ahead[:, :-1, :, None] * np.exp(steps) * back[:, 1:, None, :]
            pair /= np.maximum(pair.sum((2, 3), keepdims=True), 1e-300)
            true_pair = wanted[:, :-1, :, None] * wanted[:, 1:, None, :]
            size = mask.sum()
            step_gradient = ((true_pair - pair) * mask[:, 1:, None, None]).sum((0, 1)) / size - 1e-4 * steps
            first_gradient = gap[:, 0].sum(0) / size - 1e-4 * first
            use = table[words[mask]]
            flat = (gap * scale[words][:, :, None])[mask] / size
            gradient = np.zeros_like(weights)
            for label in range(k):
                gradient[:, label] = np.bincount(use.ravel(), np.repeat(flat[:, label], width), len(weights))
            gradient -= 1e-7 * weights
            gradient[nothing] = 0
            for value, own, total in ((weights, gradient, sums[0]), (steps, step_gradient, sums[1]), (first, first_gradient, sums[2])):
                total += own * own
                value += 0.3 * own / np.sqrt(total)
    return Chain(labels, lexicon, weights[:nothing], steps, first, proofs.astype(np.float32), spread)


def predict(known: Known, texts: list[str | None]) -> list[tuple[str, float, int, bool]]:
    """(label, share of the words with a letter, changes of label, whether proven to be in a learned language) of each text.

    Texts are walked side by side in pieces of ``PIECE`` words. A piece of a longer text takes ``MARGIN`` words on
    both sides along as context, which the chain has forgotten by then, and keeps the marginals of its own words.
    """
    model, numbers = known.model, known.numbers(texts)
    pieces = []  # (text, first word with context, end with context, first own word, end of own words)
    for i, words in enumerate(numbers):
        for a in range(0, len(words), PIECE):
            b = min(a + PIECE, len(words))
            pieces.append((i, max(0, a - MARGIN), min(len(words), b + MARGIN), a, b))
    order = sorted(range(len(pieces)), key=lambda p: pieces[p][1] - pieces[p][2])
    shares = np.zeros((len(texts), len(model.labels)))
    spoken_words, proof = np.zeros(len(texts)), np.zeros(len(texts))
    # Words that repeat are no further proof.
    proven = model.proofs is not None
    kinds = [max(1, len(np.unique(words))) for words in numbers] if proven else []
    labels: list[np.ndarray] = [np.zeros(0, int)] * len(pieces)
    at = 0
    while at < len(order):
        longest = pieces[order[at]][2] - pieces[order[at]][1]
        block = order[at : at + max(1, BATCH_WORDS // longest)]
        at += len(block)
        spans = np.array([pieces[p] for p in block])
        lengths = spans[:, 2] - spans[:, 1]
        index = np.zeros((len(block), longest), np.int64)
        for row, (i, a, b, _, _) in enumerate(spans.tolist()):
            index[row, : b - a] = numbers[i][a:b]
        told = known.table[index]
        found, _, _ = marginals(told[:, :, : len(model.labels)], lengths, model.steps, model.first)
        place = np.arange(longest)[None] + spans[:, 1:2]
        own = (place >= spans[:, 3:4]) & (place < spans[:, 4:5]) & (told[:, :, len(model.labels)] > 0)
        np.add.at(shares, spans[:, 0], (found * own[:, :, None]).sum(1))
        np.add.at(spoken_words, spans[:, 0], own.sum(1))
        if proven:
            np.add.at(proof, spans[:, 0], (told[:, :, -1] * own).sum(1))
        best = found.argmax(2)
        for row, p in enumerate(block):
            labels[p] = best[row, own[row]]
    walks: list[list[np.ndarray]] = [[] for _ in texts]
    for piece, walk in zip(pieces, labels):
        walks[piece[0]].append(walk)
    out = []
    for i, total in enumerate(spoken_words):
        if not total:
            out.append(("und", 0.0, 0, False))
            continue
        label, walk = int(shares[i].argmax()), np.concatenate(walks[i])
        out.append((model.labels[label], min(1.0, float(shares[i, label] / total)), int((walk[1:] != walk[:-1]).sum()),
                    proven and bool(proof[i] / total >= model.least_proof(kinds[i]))))
    return out


def sample(docs: DataFrame, learn: Column, size: int = SAMPLE, window: int = WINDOW) -> DataFrame:
    """Windows of words from about ``size`` labelled documents per language, at most twice as many in all."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = stored(labelled.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30))
    chosen = labelled.withColumn("drawn", drawn).join(few(counts, 64), "lang").where(F.col("drawn") * F.col("n") < F.lit(size << 30))

    def cut(batches):
        for batch in batches:
            out = {"lang": batch["lang"], "drawn": batch["drawn"], "text": []}
            for text, drawn in zip(batch["text"], batch["drawn"]):
                words = ascii_words(text)
                start = drawn % max(1, len(words) - window)
                out["text"].append(b" ".join(words[start : start + window]).decode("utf-8", "replace"))
            yield out

    cuts = run_batches(chosen.select("lang", "text", "drawn"), cut, "lang string, drawn long, text string")
    return cuts.orderBy("drawn", "lang", "text").limit(2 * size * max(1, counts.count())).select("lang", "text")


def train(docs: DataFrame, learn: Column, size: int = SAMPLE, window: int = WINDOW) -> Chain | None:
    """The model fitted on a sample of the rows that satisfy ``learn``, in one task of bounded size; None without labels."""

    def fitted(frames):
        rows = pd.concat([pd.DataFrame({"lang": [], "text": []}), *frames], ignore_index=True)
        model = fit(rows)
        if model is not None:
            yield pd.DataFrame({"model": [pickle.dumps(model.parts())]})

    found = sample(docs, learn, size, window).coalesce(1).mapInPandas(fitted, "model binary").first()
    return Chain(*pickle.loads(found.model)) if found else None


def identify(docs: DataFrame, model: Chain | None) -> DataFrame:
    """``docs`` rows ``doc_id`` with ``lang_pred``, ``score`` and ``n_switches``."""
    sent = docs.sparkSession.sparkContext.broadcast(model.parts(proofs=False) if model else None)

    def rows(batches):
        known = Known(Chain(*sent.value)) if sent.value else None
        for batch in batches:
            texts = batch["text"]
            found = predict(known, texts) if known is not None else [("und", 0.0, 0)] * len(texts)
            yield {**{x: batch[x] for x in ("doc_id", "row_key")}, "lang_pred": [x[0] for x in found],
                   "score": [x[1] for x in found], "n_switches": [x[2] for x in found]}

    return run_batches(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text"), rows,
                       "doc_id long, row_key long, lang_pred string, score double, n_switches long")


def keep_spoken(docs: DataFrame, model: Chain | None, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` in learned languages, with one whose share is at least ``least``; columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model.parts() if model else None)
    place, schema = docs.columns.index("text"), docs.schema

    def rows(batches):
        import pyarrow as pa

        known = Known(Chain(*sent.value)) if sent.value else None
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = predict(known, texts) if known is not None else [("und", 0.0, 0, False)] * len(texts)
            yield batch.filter(pa.array([x[0] != "und" and x[1] >= least and x[3] for x in found], pa.bool_()))

    return docs.mapInArrow(rows, schema)
