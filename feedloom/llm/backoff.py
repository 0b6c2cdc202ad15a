"""Language-model scores by a weighted backoff automaton.

Training texts give counts of words and of n-grams up to ``order``. The probability of a word after a history is smoothed
towards the shorter history, ``(c(h w) + k P(w | h')) / (c(h) + k)``, down to add-one word probabilities; it sums to
one over the known words and one unknown. As an automaton: a history seen in training is a state, an n-gram seen in
training is an arc from the state of its history, with its log probability, to the state of the longest history it ends
with; every state has a failure arc with weight ``log(k / (c(h) + k))`` to the state of the shorter history. The empty
history has an arc for every word. A text is scored in one traversal from left to right that carries the state: at each
word it follows failure arcs until the state has an arc for the word, takes it, and adds up the weights. Texts are walked side
by side, long ones in pieces, each of which enters its state by reading the ``order - 1`` words before it.

The automaton grows with the corpus, so no task holds all of it. Texts are read once into lots of about ``LOT_WORDS``
words, in which words are numbers of a local list. A lot asks for the distinct n-grams it contains, with its own
counts; requests meet in parts of the hash range, where the counts of all lots add up, and the totals go back in
the order of the request. A history is an n-gram itself and occurs as often, as every word but the end mark is followed by
another; the start marks occur as often as the end mark. So a lot builds just the states and arcs its texts can reach,
with counts over the whole corpus, and walks its texts. An n-gram that all texts share is one number per lot and part; no
key gathers rows of the corpus.

Edge cases: a null or empty text is its end mark only; a null id is neither held out nor left out of
training; without training texts every count is 0; repeated rows count as often as they occur; an empty table gives an
empty result. Words and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import lower_words, mix, run_batches, stored

LOT_WORDS = 1 << 20
PART_WORDS = 1 << 21
ORDER = 2
STRENGTH = 4.0  # k
SIDE_BY_SIDE = 1 << 12  # pieces that a lot is cut into
END_MARK = b"\n"  # no word holds a line feed
START = np.uint64(xxhash.xxh3_64_intdigest(b"\n\n"))
TOP = np.uint64((1 << 64) - 1)


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _numbers() -> defaultdict:
    """Words to numbers in the order they are first asked for; the end mark has number 0."""
    known = defaultdict()
    known.default_factory = known.__len__
    known[END_MARK] = 0
    return known


def _lots(limit: int):
    """Row function: texts to lots with local word numbers; each text ends with the end mark (number 0)."""

    def close(lot: dict, known: dict, number: int) -> dict:
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        tokens = np.concatenate(lot["tokens"])
        order = np.argsort(words)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        return {
            "lot": [number], "ids": [lot["ids"]], "held": [lot["held"]], "lengths": [lot["lengths"]],
            "tokens": [_packed(place[tokens])],
            "words": [_packed(np.diff(words[order], prepend=np.uint64(0)))], "n_tokens": [len(tokens)],
        }

    def rows(batches):
        number = (TaskContext.get().partitionId() << 32) - 1
        lot, known, size = {"ids": [], "held": [], "lengths": [], "tokens": []}, _numbers(), 0
        for batch in batches:
            for doc, held, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                words = lower_words(text)
                words.append(END_MARK)
                lot["ids"].append(doc)
                lot["held"].append(held)
                lot["lengths"].append(len(words))
                lot["tokens"].append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                size += len(words)
                if size >= limit:
                    number += 1
                    yield close(lot, known, number)
                    lot, known, size = {"ids": [], "held": [], "lengths": [], "tokens": []}, _numbers(), 0
        if size:
            yield close(lot, known, number + 1)

    return rows


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the first place of each, and for every place the number of its key.

    The upper bits of a key and its place are sorted as one number, which is faster than sorting places by keys. Where
    the upper bits alone do not order the keys, places are sorted by whole keys.
    """
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, bits = keys.min(), np.uint64((len(keys) - 1).bit_length())
    unused = np.uint64(64 - int(keys.max() - low).bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    places = np.sort((((keys - low) << unused) & ~mask) | np.arange(len(keys), dtype=np.uint64))
    places = (places & mask).astype(np.int64)
    ordered = keys[places]
    if (ordered[1:] < ordered[:-1]).any():
        return np.unique(keys, return_index=True, return_inverse=True)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    which = np.empty(len(keys), np.int64)
    which[places] = np.cumsum(new) - 1
    return ordered[new], places[new], which


class Grams:
    """Distinct keys of the n-grams of a kind in a lot: a place of each, the key of each place, and training counts."""

    def __init__(self, keys: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.keys, self.first, self.which = found or distinct(keys)
        self.totals = np.zeros(len(self.keys))


class Lot:
    """Texts of a lot: for each token its hash and its number in ``words``, the hashes of the lot's words in order."""

    def __init__(self, row):
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.held = np.asarray([bool(x) for x in row["held"]])
        self.words = np.cumsum(_unpacked(row["words"], np.uint64), dtype=np.uint64)
        self.word = _unpacked(row["tokens"], np.uint32).astype(np.int64)
        self.tokens = self.words[self.word]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held, self.lengths)

    def keys(self, order: int) -> dict[int, np.ndarray]:
        """Key per token, by n, of the token and the n - 1 tokens before it; start marks stand before the text.

        The history of a token is the n-gram of the token before it, so it has the same key.
        """
        found, start = {1: self.tokens}, START
        for n in range(2, order + 1):
            history = np.empty_like(self.tokens)
            history[1:] = found[n - 1][:-1]
            history[self.starts] = start
            found[n] = _behind(history, n) + self.tokens
            start = _start(n)
        return found

    def grams(self, order: int) -> dict[int, Grams]:
        keys = self.keys(order)
        # Words are numbered in order of their hashes, and each has a place.
        first = np.empty(len(self.words), np.int64)
        first[self.word[::-1]] = np.arange(len(self.word))[::-1]
        found = {1: Grams(keys[1], (self.words, first, self.word))}
        return found | {n: Grams(keys[n]) for n in range(2, order + 1)}


def _behind(history: np.ndarray, n: int) -> np.ndarray:
    """What the key of a history adds to the hash of a word to make the key of an n-gram."""
    return mix(history ^ np.uint64(n))


def _start(n: int) -> np.uint64:
    """Key of the history of n start marks."""
    key = np.array([START])
    for k in range(2, n + 1):
        key = _behind(key, k) + START
    return key[0]


def _requests(order: int, parts: int):
    """Row function: the distinct n-grams of a lot by n and part of the hash range, with the lot's training counts."""

    def rows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lot = Lot(row)
                for kind, own in lot.grams(order).items():
                    every = own.keys
                    counts = np.bincount(own.which[lot.train], minlength=len(every)).astype(np.uint32)
                    part = _part(every, parts)
                    first = np.flatnonzero(np.diff(part, prepend=-1))
                    # Only parts with a key are named, so the work follows the keys, however many parts there are.
                    for a, b in zip(first, np.append(first[1:], len(every))):
                        yield pa.RecordBatch.from_pydict({
                            "kind": pa.array([kind], pa.int32()), "part": pa.array([part[a]], pa.int64()),
                            "lot": pa.array([row["lot"]], pa.int64()),
                            "keys": pa.array([_packed(np.diff(every[a:b], prepend=np.uint64(0)))], pa.binary()),
                            "counts": pa.array([_packed(counts[a:b])], pa.binary())})

    return rows


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Number of the part of the 64-bit range, cut into equal ones, that each key lies in."""
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _totals(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of all lots for each lot's keys, in the order of its request; sums for the whole part."""
    keys = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in rows["keys"]]
    counts = np.concatenate([_unpacked(x, np.uint32) for x in rows["counts"]])
    every, _, which = distinct(np.concatenate(keys))
    total = np.bincount(which, weights=counts, minlength=len(every)).astype(np.uint64)
    ends = np.cumsum([len(x) for x in keys])[:-1]
    out = rows[["kind", "part", "lot"]].copy()
    out["totals"] = [_packed(total[x]) for x in np.split(which, ends)]
    out["types"], out["sum"] = 0, 0
    out.loc[out.index[0], ["types", "sum"]] = int((total > 0).sum()), int(total.sum())
    return out


class Automaton:
    """States, arcs and failure arcs that the texts of a lot can reach.

    State 0 is the empty history. ``fail_weights``, ``fail_targets`` and ``levels`` (tokens of the history) belong to states;
    ``start`` is the state before a text. Arcs lie by level of their state, and in a level by key: ``behind`` of the state plus
    the hash of the word. ``weights`` and ``targets`` belong to them. ``buckets`` tells where the keys of a level
    with the same upper bits begin; ``bucket`` is a state's first one. Each level ends with a key above all others.
    """

    def __init__(self, lot: Lot, grams: dict[int, Grams], order: int, strength: float, base: np.ndarray):
        size, self.word, self.words, self.order = len(lot.tokens), lot.word, lot.words, order
        ends, last = lot.starts + lot.lengths - 1, np.zeros(size, bool)
        last[ends] = True
        # As often as a text begins, one ends.
        begun = float(grams[1].totals[lot.word[ends[0]]]) if size else 0.0
        # The state of each position's history of n tokens; -1 where training has not seen it.
        state = [np.zeros(size, np.int64)]
        fail_weights, fail_targets, levels = [np.zeros(1)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        behind, known = [np.zeros(1, np.uint64)], 1
        for n in range(1, order):
            own = grams[n]
            # An n-gram is a history if a token follows it; the n start marks are one, too.
            seen = (own.totals > 0) & ~last[own.first]
            number = np.where(seen, np.cumsum(seen) - 1 + known, -1)
            known += int(seen.sum())
            here = np.empty(size, np.int64)
            here[1:] = number[own.which[:-1]]
            here[lot.starts] = known if begun else -1
            totals, at, keys = own.totals[seen], own.first[seen] + 1, own.keys[seen]
            if begun:
                totals, at, keys = np.append(totals, begun), np.append(at, 0), np.append(keys, _start(n))
                known += 1
            fail_weights.append(np.log10(strength / (totals + strength)))
            fail_targets.append(state[n - 1][at])
            levels.append(np.full(len(at), n))
            behind.append(_behind(keys, n + 1))
            state.append(here)
        self.fail_weights, self.fail_targets = np.concatenate(fail_weights), np.concatenate(fail_targets)
        self.levels, self.behind = np.concatenate(levels), np.concatenate(behind)
        # The longest history seen, of at most n tokens.
        longest = [state[0]]
        for n in range(1, order):
            longest.append(np.where(state[n] >= 0, state[n], longest[-1]))
        self.start = int(longest[-1][0]) if size else 0
        upper = max(1, max(len(own.keys) for own in grams.values()).bit_length())
        self.shift = np.uint64(64 - upper)
        keys, weights, targets, buckets, weight, placed = [], [], [], [], base, 0
        for n in range(1, order + 1):
            own = grams[n]
            taken = np.ones(len(own.first), bool)
            if n > 1:
                # What the shorter history gives the word, and what this one has seen.
                shorter = weight[grams[n - 1].which[own.first]]
                history = np.append(grams[n - 1].totals, begun)
                before = np.where(last[own.first - 1], -1, grams[n - 1].which[own.first - 1])
                total = history[before] + strength
                taken = own.totals > 0
                arc = np.log10(np.maximum(own.totals + strength * 10.0**shorter, 1e-300) / total)
                weight = np.where(taken, arc, shorter + np.log10(strength / total))
            at = own.first[taken]
            keys += [own.keys[taken], [TOP]]
            weights += [weight[taken], [0.0]]
            # A text goes on in the next position; its last arc, at the end mark, leads nowhere.
            targets += [longest[min(n, order - 1)][np.minimum(at + 1, size - 1)], [0]]
            filled = np.bincount((own.keys[taken] >> self.shift).astype(np.int64), minlength=1 << upper)
            buckets.append((np.cumsum(filled) - filled + placed).astype(np.int32))
            placed += len(at) + 1
        self.bucket = self.levels << upper
        self.keys, self.weights, self.targets = np.concatenate(keys), np.concatenate(weights), np.concatenate(targets)
        self.buckets = np.concatenate(buckets)

    def walk(self, starts: np.ndarray, lengths: np.ndarray, path: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each text; ``path`` gets the state in which each word was read.

        Texts are walked side by side, one word of each at a time. Long ones are cut for it: as a state holds ``order - 1`` words
        at most, the walk of a piece reads so many words before it, from the empty history, to be in the state in which the
        piece before ended.
        """
        long = max(1, -(-int(lengths.sum()) // SIDE_BY_SIDE))
        pieces = -(-lengths // long)
        begin = np.cumsum(pieces) - pieces
        text = np.repeat(np.arange(len(starts)), pieces)
        offset = (np.arange(len(text)) - begin[text]) * long
        words = np.minimum(lengths[text] - offset, long)
        longest_first = np.argsort(-words, kind="stable")
        offset, words = offset[longest_first], words[longest_first]
        at = starts[text][longest_first] + offset
        states, scores = np.where(offset < self.order, self.start, 0), np.zeros(len(text))
        for back in range(self.order - 1, 0, -1):
            late = np.flatnonzero(offset >= back)
            states[late] = self.targets[self._read(states[late], self.word[at[late] - back])[0]]
        # How many pieces have a word left at each step.
        left = np.searchsorted(-words, -np.arange(1, (words.max() if len(words) else 0) + 1), "right")
        for step, n in enumerate(left.tolist()):
            here = at[:n] + step
            arc, state, failed = self._read(states[:n], self.word[here])
            if path is not None:
                path[here] = state
            scores[:n] += failed
            scores[:n] += self.weights[arc]
            states[:n] = self.targets[arc]
        whole = np.empty(len(text))
        whole[longest_first] = scores
        return np.add.reduceat(whole, begin) if len(begin) else whole

    def _read(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arc that each state takes for its word, the state it leaves, and the weights of the failure arcs before it."""
        arc, found = self._arcs(state, word)
        failed, lost = np.zeros(len(state)), np.flatnonzero(~found)
        if len(lost):
            state = state.copy()
        while len(lost):
            failed[lost] += self.fail_weights[state[lost]]
            state[lost] = self.fail_targets[state[lost]]
            arc[lost], found = self._arcs(state[lost], word[lost])
            lost = lost[~found]
        return arc, state, failed

    def _arcs(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arc of each state for its word, and whether there is one."""
        wanted = self.behind[state] + self.words[word]
        arc = self.buckets[self.bucket[state] + (wanted >> self.shift).astype(np.int64)].astype(np.int64)
        key = self.keys[arc]
        short = np.flatnonzero(key < wanted)
        while len(short):
            arc[short] += 1
            key[short] = self.keys[arc[short]]
            short = short[key[short] < wanted[short]]
        return arc, key == wanted


def _score(order: int, strength: float, train_tokens: int, vocabulary: int):
    def score(lots: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in lots.to_dict("records"):
            lot = Lot(row)
            grams = lot.grams(order)
            for kind in grams:
                own = answers[answers["kind"] == kind].sort_values("part")
                totals = np.concatenate([_unpacked(x, np.uint64) for x in own["totals"]]) if len(own) else np.zeros(0, np.uint64)
                if len(totals) != len(grams[kind].first):
                    raise ValueError(f"lot {row['lot']}: {len(totals)} answers for {len(grams[kind].first)} keys")
                grams[kind].totals = totals.astype(np.float64)
            count, place = grams[1].totals, grams[1].which
            base = np.log10((count + 1) / (train_tokens + vocabulary + 1))
            automaton = Automaton(lot, grams, order, strength, base)
            del grams
            scores = automaton.walk(lot.starts, lot.lengths)
            add = lambda x: np.add.reduceat(x, lot.starts)
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(row["ids"]), "Int64"), "held_out": lot.held, "n_tokens": lot.lengths,
                "n_known": add((count > 0).astype(np.int64)[place]), "train_tokens": train_tokens,
                "base_score": add(base[place]), "score": scores}))
        return pd.concat(out, ignore_index=True)

    return score


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(
    docs: DataFrame, order: int = ORDER, strength: float = STRENGTH, lot_words: int = LOT_WORDS, part_words: int = PART_WORDS,
) -> DataFrame:
    """One row per document of ``doc_id, text, held_out``; the model learns from those not held out."""
    lots = stored(run_batches(
        docs.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text"), _lots(lot_words),
        "lot long, ids array<bigint>, held array<boolean>, lengths array<bigint>, tokens binary, words binary, n_tokens long"),
        "lots")
    tokens = lots.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parts = max(1, -(-tokens // part_words))
    asked = lots.mapInArrow(_requests(order, parts), "kind int, part long, lot long, keys binary, counts binary")
    answers = stored(asked.groupBy("kind", "part").applyInPandas(
        _totals, "kind int, part long, lot long, totals binary, types long, sum long"), "answers")
    train_tokens, vocabulary = answers.where("kind = 1").agg(
        F.coalesce(F.sum("sum"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    scored = lots.drop("n_tokens").groupBy("lot").cogroup(answers.select("lot", "kind", "part", "totals").groupBy("lot"))
    return scored.applyInPandas(_score(order, strength, train_tokens, vocabulary), RESULT)
