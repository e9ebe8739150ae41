"""Language identification by unigram piece models, summed over all segmentations.

Each language has a probability per piece of a fixed public vocabulary, fitted by expectation
maximisation. The probability of a word in a language is the sum over every way to cut it into
pieces, by the forward algorithm; a text is its words, and a word is a run of letters in lower
case. All lattices of a batch of words are run together, position by position, in numpy.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilode.llm.common import slices

UND = "und"
# Bounds, for each language, of the sample from which its model is fitted: distinct texts, about, and
# most frequent words. A language with fewer is learned from all it has; every document is scored.
TRAIN_DOCS = 1000
TRAIN_WORDS = 12_500
ROUNDS = 2
# Share of each language's probability that is spread evenly over all pieces.
SMOOTHING = 0.001
MAX_WORD = 64
CACHE_WORDS = 200_000
# Characters of text whose new words are scored together.
CHUNK = 1 << 20
SCALE = np.log(64)
BASE = 1_000_003
# Letters, and number signs such as a half, which are told apart in a second step where there are any.
_WORD = re.compile(r"[^\W\d_]+")
_LETTER = r"\p{L}"
# Lattice columns of a batch of words: fewer words where there are many languages.
CELLS = 25_000


def words_in(text: str) -> Iterator[str]:
    """Runs of letters in lower case, one after another."""
    for m in _WORD.finditer(text.lower()):
        if m[0].isalpha():
            yield m[0]
        else:
            yield from "".join(c if c.isalpha() else " " for c in m[0]).split()


def public_pieces(path: str | None = None) -> list[str]:
    """Pieces of the public vocabulary: letters only, in lower case, the word start as ``\\u2581``."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if re.fullmatch(r"▁|▁?[^\W\d_]+", p)})


class Arcs(NamedTuple):
    """Lattices of many words: arcs sorted by end position; ``bounds[e]`` is where end ``e`` starts."""

    words: int
    word: np.ndarray
    start: np.ndarray
    piece: np.ndarray
    bounds: np.ndarray
    length: np.ndarray


class Trie(NamedTuple):
    """Prefixes of the pieces by length: sorted hashes, and the piece each is, or -1."""

    hashes: list[np.ndarray]
    piece: list[np.ndarray]

    @staticmethod
    def of(pieces: list[str]) -> Trie:
        levels: list[dict[int, int]] = [{} for _ in range(max(map(len, pieces), default=0))]
        for k, piece in enumerate(pieces):
            h = 0
            for i, letter in enumerate(piece):
                h = (h * BASE + ord(letter)) & (2**64 - 1)
                levels[i].setdefault(h, -1)
            levels[len(piece) - 1][h] = k
        order = [sorted(level) for level in levels]
        return Trie([np.array(keys, np.uint64) for keys in order],
                    [np.array([level[h] for h in keys], np.int64)
                     for keys, level in zip(order, levels)])


class Model(NamedTuple):
    """Log-probabilities ``logp[piece, language]``; the last piece is any unknown letter, and the last
    column is a background model of even probabilities, which stands for none of the languages."""

    langs: tuple[str, ...]
    trie: Trie
    length: np.ndarray
    logp: np.ndarray

    def arcs(self, words: list[str]) -> Arcs:
        """Every piece at every position of ``"\u2581" + word``, found length by length: a
        substring is looked up only if it was still the prefix of a piece one letter earlier."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        letters = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), lengths)
        start = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = lengths[word] - start
        at, hashes = np.arange(len(letters)), np.zeros(len(letters), np.uint64)
        found, known = [], np.zeros(len(letters), bool)
        for size, (table, piece) in enumerate(zip(*self.trie), 1):
            hashes = hashes * np.uint64(BASE) + letters[at + size - 1]
            slot = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
            alive = table[slot] == hashes
            at, hashes, slot = at[alive], hashes[alive], slot[alive]
            is_piece = piece[slot] >= 0
            found.append((at[is_piece], np.full(is_piece.sum(), size), piece[slot[is_piece]]))
            if size == 1:
                known[at[is_piece]] = True
            more = left[at] > size
            at, hashes = at[more], hashes[more]
        rare = np.flatnonzero(~known)
        found.append((rare, np.ones(len(rare), np.int64), np.full(len(rare), len(self.length) - 1)))
        at, size, piece = (np.concatenate(x) for x in zip(*found))
        end = start[at] + size
        order = np.lexsort((word[at], end))
        at, end = at[order], end[order]
        bounds = np.searchsorted(end, np.arange(lengths.max(initial=0) + 2))
        return Arcs(len(words), word[at], start[at], piece[order], bounds, lengths)

    def forward(self, arcs: Arcs) -> np.ndarray:
        """``alpha[word, position, language]``: the sum over segmentations of each prefix, with a
        factor of ``SCALE`` per letter that keeps it within the range of a double."""
        top = int(arcs.length.max(initial=0))
        prob = self.scaled()
        alpha = np.zeros((arcs.words, top + 1, len(self.langs) + 1))
        alpha[:, 0] = 1.0
        for end in range(1, top + 1):
            at = slice(arcs.bounds[end], arcs.bounds[end + 1])
            word = arcs.word[at]
            value = alpha[word, arcs.start[at]] * prob[arcs.piece[at]]
            first = np.flatnonzero(np.diff(word, prepend=-1))  # arcs of an end are in word order
            alpha[word[first], end] = np.add.reduceat(value, first, axis=0)
        return alpha

    def scaled(self) -> np.ndarray:
        return np.exp(self.logp + self.length[:, None] * SCALE)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language and in the background; a word of more than ``MAX_WORD`` letters
        is scored piecewise in runs of that length."""
        runs = [[w[i:i + MAX_WORD] for i in range(0, len(w), MAX_WORD)] for w in words]
        flat = [r for parts in runs for r in parts]
        out = np.zeros((len(words), len(self.langs) + 1))
        owner = np.repeat(np.arange(len(words)), [len(p) for p in runs])
        step = max(1, CELLS // out.shape[1])
        for i in range(0, len(flat), step):
            arcs = self.arcs(flat[i:i + step])
            whole = self.forward(arcs)[np.arange(arcs.words), arcs.length]
            np.add.at(out, owner[i:i + step], np.log(whole) - arcs.length[:, None] * SCALE)
        return out


def fit_model(counts: Iterable[tuple[str, str, int]], pieces: list[str],
              rounds: int = ROUNDS) -> Model:
    """Expectation maximisation over ``(lang, word, count)``, one language at a time."""
    words: dict[str, Counter] = {}
    for lang, word, n in counts:
        words.setdefault(lang, Counter())[word[:MAX_WORD]] += n
    langs = tuple(sorted(words))
    model = Model(langs, Trie.of(pieces), np.array([*map(len, pieces), 1]),
                  np.full((len(pieces) + 1, len(langs) + 1), -np.log(len(pieces) + 1.0)))
    for k, lang in enumerate(langs):
        model.logp[:, k] = _learned(model, words[lang], rounds)
    return model


def _learned(blank: Model, counts: Counter, rounds: int) -> np.ndarray:
    """The column of one language, starting from even probabilities."""
    words = sorted(counts)
    weight = np.array([counts[w] for w in words], float)[:, None]
    model = blank._replace(langs=(), logp=blank.logp[:, -1:])
    parts = [(model.arcs(words[i:i + 5_000]), weight[i:i + 5_000])
             for i in range(0, len(words), 5_000)]
    for _ in range(rounds):
        expected = sum(_expected(arcs, model.forward(arcs), model.scaled(), counted)
                       for arcs, counted in parts)
        share = expected / expected.sum()
        model = model._replace(logp=np.log((1 - SMOOTHING) * share + SMOOTHING / len(share)))
    return model.logp[:, 0]


def _expected(arcs: Arcs, alpha: np.ndarray, prob: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, by pushing each word's weight back along its arcs."""
    beta = np.zeros_like(alpha)
    beta[np.arange(arcs.words), arcs.length] = weight
    uses = np.zeros_like(prob)
    for end in range(alpha.shape[1] - 1, 0, -1):
        at = slice(arcs.bounds[end], arcs.bounds[end + 1])
        word, start, piece = arcs.word[at], arcs.start[at], arcs.piece[at]
        share = alpha[word, start] * prob[piece] / alpha[word, end] * beta[word, end]
        np.add.at(uses, piece, share)
        np.add.at(beta, (word, start), share)
    return uses


def fit(docs: DataFrame, learn_from: Column, text_col: str = "text", lang_col: str = "lang",
        pieces: list[str] | None = None) -> Model:
    """Fit each language on about ``TRAIN_DOCS`` of its distinct texts where ``learn_from`` holds, or
    all if there are fewer, from their ``TRAIN_WORDS`` most frequent words.

    Texts without a letter teach nothing and are not drawn, so every language that has another text
    gets a model. Texts are chosen by a hash: the same ones on every run.
    """
    known = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).rlike(_LETTER)
                       ).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                                F.xxhash64(text_col).alias("hash"))
    # One row per language, counted without copies: a text that very many rows share counts once.
    sizes = known.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("of"))
    chosen = F.pmod("hash", F.lit(1 << 30)) < F.lit(TRAIN_DOCS) / F.col("of") * (1 << 30)
    rows = known.join(F.broadcast(sizes), "lang").where(chosen).select("text", "lang").distinct()

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: Counter = Counter()
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                seen.update((lang, w) for w in words_in(text))
            yield pa.RecordBatch.from_pydict({
                "lang": [k[0] for k in seen], "word": [k[1] for k in seen],
                "n": list(seen.values())},
                schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (rows.mapInArrow(tally, "lang string, word string, n bigint")
           .groupBy("lang", "word").agg(F.sum("n").alias("n"))
           .withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= TRAIN_WORDS)
           .select("lang", "word", "n").toArrow())
    counts = zip(*(top[name].to_pylist() for name in ("lang", "word", "n")))
    return fit_model(counts, pieces or public_pieces())


class Scorer:
    """Scores texts, remembering the scores of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs) + 1))

    def _learn(self, words: Iterable[str]) -> None:
        if len(self.rows) > CACHE_WORDS:
            self.rows.clear()
        new = [w for w in words if w not in self.rows]
        base = len(self.rows)
        if base + len(new) > len(self.scores):
            more = max(1 << 15, base + len(new))
            self.scores = np.resize(self.scores, (base + more, self.scores.shape[1]))
        self.rows.update((w, base + i) for i, w in enumerate(new))
        self.scores[base:base + len(new)] = self.model.word_scores(new)

    def batch(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        while len(out) < len(texts):
            part, size = [], 0
            for text in texts[len(out):]:
                size += len(text or "")
                if part and size > CHUNK:
                    break
                part.append(text)
            if len(part) > 1:
                self._learn({w for t in part if t for w in words_in(t)})
            out += map(self.one, part)
        return out

    def one(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share against all others and the background."""
        if not self.model.langs:
            return UND, 0.0
        found = words_in(text) if text else iter(())
        total, empty = np.zeros(len(self.model.langs) + 1), True
        while part := Counter(islice(found, 1 << 16)):
            self._learn(part)
            at = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            n = np.fromiter(part.values(), np.float64, len(part))
            total += n @ self.scores[at]
            empty = False
        if empty:
            return UND, 0.0
        best = int(total[:-1].argmax())
        rivals = np.minimum(total - total[best], 700)
        return self.model.langs[best], float(1 / np.exp(rivals).sum())


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1.

    A text that is null or has no letter gets ``und`` and 0, as does every text if no language was
    learned. The score is the probability against the other languages and the background model, so
    it is near 0 for texts of a script none of them uses. Ties go to
    the first language by name. Other columns pass through; columns with the names of the two new
    ones are replaced.
    """
    rest = docs.drop(lang_col, score_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches):
            found = scorer.batch(batch[batch.schema.get_field_index(text_col)].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                names=[*batch.schema.names, lang_col, score_col])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(add, f"{columns}, `{lang_col}` string, `{score_col}` double")
