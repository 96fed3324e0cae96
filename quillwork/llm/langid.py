"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for each piece of the vocabulary. A word's probability is the sum over all ways to cut
it into pieces of the product of their probabilities, by a forward algorithm; a text's is the product over its words.
No piece reaches over a word's end, so the sum over all cuts of a text is the product of its words' sums, and each
distinct word is scored once per task. Words are runs of letters, lower-cased.

Training: all words of up to `docs_per_lang` labelled documents of each language are the bounded sample; piece
probabilities are fitted to their counts by expectation-maximisation with the same lattice. Everything is scored over
whole texts. A model has a column per language; of more than `max_langs` labels none is fitted (an error).

Defined cases: text null or without letters (number characters such as ½ are none) gives `und` and score 0. A training set
without labels gives `und` for all. Ties go to the language first by code point. Rows are scored one by one, so repeated
rows and null ids are like any other; in training, rows that share a doc_id are chosen together. Texts of any length are
read whole. Input columns named lang_pred or score are replaced; all others stay. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep_only, kept

UND = "und"
#: What Python's \\w takes beyond letters, decimals and the underscore: fractions, superscripts, letter-like numerals.
_NUMBERS = frozenset(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_BLANKS = {ord(c): " " for c in _NUMBERS}
_LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"  # the vocabulary's mark for a word's start


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> list[str]:
    """The vocabulary's pieces of letters (and START), in order of their ids. Others cannot occur in a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    return list(dict.fromkeys(p for p in pieces if p == START or p.removeprefix(START).isalpha()))


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased. Number characters part them; they are looked for by a set, for a pattern with all of
    them costs ten times the time."""
    low = text.lower()
    if not low.isascii() and not _NUMBERS.isdisjoint(low):
        low = low.translate(_BLANKS)
    return _LETTERS.findall(low)


class Lattice:
    """All pieces in all words of a list, found in one pass of an automaton."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.lengths = np.array([len(p) for p in pieces] + [1])  # the last stands for any one unknown character
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Per edge, sorted by (its end within the word, node): the node at its end, the node at its start, the piece.
        Word k's nodes are base[k] (before its START) to base[k] + len + 1. Then the steps: edge ranges with ends alike."""
        lens = np.array([len(w) + 1 for w in words])
        base = np.cumsum(lens + 1) - (lens + 1)
        joined = "\n".join(START + w for w in words)
        found = np.fromiter((x for end, i in self.automaton.iter(joined) for x in (end, i)), np.int64).reshape(-1, 2)
        # position p of word k in joined is node base[k] + (p - base[k]) + 1 after it: both advance by len + 1 a word
        end, piece = found[:, 0] + 1, found[:, 1]
        start = end - self.lengths[piece]
        total = int((lens + 1).sum())
        heads = np.zeros(total, bool)
        heads[base] = True
        nodes = np.flatnonzero(~heads)
        end, start, piece = np.concatenate([end, nodes]), np.concatenate([start, nodes - 1]), np.concatenate([piece, np.full(len(nodes), self.size)])
        word = np.repeat(np.arange(len(words)), lens + 1)
        depth = end - base[word[end]]
        order = np.lexsort((end, depth))
        return end[order], start[order], piece[order], depth[order], base, base + lens

    def forward(self, words: list[str], logp: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """alpha (nodes x languages), logs of the sums over all cuts up to each node; and the edges."""
        e = end, start, piece, depth, base, _ = self.edges(words)
        alpha = np.full((int(end.max()) + 1, logp.shape[1]), -np.inf)
        alpha[base] = 0
        steps = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True])
        for a, b in zip(steps[:-1], steps[1:], strict=True):
            ends = end[a:b]
            first = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            alpha[ends[first]] = np.logaddexp.reduceat(alpha[start[a:b]] + logp[piece[a:b]], first, axis=0)
        return alpha, e

    def score(self, words: list[str], logp: np.ndarray, chars: int = 100_000) -> np.ndarray:
        """log probability of each word in each language; long lists go in portions of bounded size."""
        out, at = [], 0
        while at < len(words):
            to, n = at, 0
            while to < len(words) and (to == at or n + len(words[to]) <= chars):
                n, to = n + len(words[to]) + 2, to + 1
            alpha, e = self.forward(words[at:to], logp)
            out.append(alpha[e[5]])
            at = to
        return np.concatenate(out) if out else np.zeros((0, logp.shape[1]))

    def expected(self, words: list[str], counts: np.ndarray, logp: np.ndarray, portion: int = 20_000) -> np.ndarray:
        """Expected uses of each piece in the words, summed over portions of them. logp: one language's."""
        uses = np.zeros(self.size + 1)
        for at in range(0, len(words), portion):
            uses += self._expected(words[at : at + portion], counts[at : at + portion], logp)
        return uses

    def _expected(self, words: list[str], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """The same of one portion, by forward and backward sums."""
        alpha, (end, start, piece, depth, base, last) = self.forward(words, logp[:, None])
        alpha = alpha[:, 0]
        beta = np.full(len(alpha), -np.inf)
        beta[last] = 0
        order = np.lexsort((start, -(depth - self.lengths[piece])))
        end, start, piece = end[order], start[order], piece[order]
        at = (depth - self.lengths[piece[np.argsort(order)]])[order]
        steps = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True])
        for a, b in zip(steps[:-1], steps[1:], strict=True):
            first = np.flatnonzero(np.r_[True, start[a + 1 : b] != start[a : b - 1]])
            beta[start[a:b][first]] = np.logaddexp.reduceat(beta[end[a:b]] + logp[piece[a:b]], first)
        word = np.searchsorted(base, end, side="right") - 1
        share = np.exp(alpha[start] + logp[piece] + beta[end] - alpha[last][word])
        return np.bincount(piece, share * counts[word], self.size + 1)


def fit(pieces: list[str], samples: dict[str, dict[str, int]], rounds: int = 4, smooth: float = 0.1, unknown: float = -14.0) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities (pieces + 1) x languages. unknown: log probability of a character by itself."""
    lattice, langs, columns = Lattice(pieces), sorted(samples), []
    for lang in langs:
        words, counts = list(samples[lang]), np.array(list(samples[lang].values()), float)
        logp = np.full(len(pieces) + 1, -np.log(len(pieces)))
        logp[-1] = unknown
        for _ in range(rounds):
            uses = lattice.expected(words, counts, logp)[:-1] + smooth
            logp = np.r_[np.log(uses / uses.sum()), unknown]
        columns.append(logp)
    return langs, np.stack(columns, axis=1) if columns else np.zeros((len(pieces) + 1, 0))


def training_words(spark: SparkSession, docs: DataFrame, docs_per_lang: int = 400, seed: int = 5, max_langs: int = 1000) -> dict[str, dict[str, int]]:
    """The bounded sample: word counts by language. Documents are chosen and words counted on the executors."""
    labelled = docs.where("lang is not null and text is not null")
    sizes = labelled.groupBy("lang").count().limit(max_langs + 1).collect()
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    # of each language the documents of least hash, about twice as many as wanted, are ranked: some rows in all
    shares = [(r["lang"], min(1.0, (2 * docs_per_lang + 100) / r["count"])) for r in sizes]
    limits = spark.createDataFrame(shares, "lang string, share double")
    h = F.xxhash64(F.lit(seed), "doc_id")
    pick = Window.partitionBy("lang").orderBy(h, "doc_id")
    near = labelled.select("lang", "doc_id").join(F.broadcast(limits), "lang").where((h.cast("double") / 2.0**64 + 0.5) <= F.col("share"))
    chosen = near.select("lang", "doc_id").withColumn("n", F.row_number().over(pick)).where(F.col("n") <= docs_per_lang).select("lang", "doc_id").distinct()
    texts = labelled.join(F.broadcast(chosen), ["lang", "doc_id"])  # at most docs_per_lang ids a language
    words = texts.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    counts = words.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("c"))
    out: dict[str, dict[str, int]] = {}
    for row in counts.orderBy("lang", F.desc("c"), "w").collect():
        if row["w"].isalpha():
            out.setdefault(row["lang"], {})[row["w"].lower()] = row["c"]
    return {k: v for k, v in out.items() if v}


class Scorer:
    """Scores texts with one model; distinct words are kept, up to `most`."""

    def __init__(self, model: bytes, most: int = 200_000):
        pieces, self.langs, self.logp = pickle.loads(model)
        self.lattice, self.most = Lattice(pieces), most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.index) > self.most:
            self.clear()
        found = [words_of(t) if t else [] for t in texts]
        if self.langs:
            new = list(set().union(*(set(x).difference(self.index) for x in found)))
            if new:
                self.scores = np.concatenate([self.scores, self.lattice.score(new, self.logp)])
                self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        out, sure = [], []
        for words in found:
            if not words or not self.langs:
                out.append(UND)
                sure.append(0.0)
                continue
            total = self.scores[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(np.argmax(total))
            out.append(self.langs[best])
            sure.append(float(1 / np.exp(total - total[best]).sum()))
        return out, sure


@functools.lru_cache(maxsize=2)
def scorer(model: bytes) -> Scorer:
    """One per Python worker, kept between tasks."""
    return Scorer(model)


kept("langid", scorer)


def train(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, **bounds) -> bytes:
    """A model fitted to labelled docs (doc_id, text, lang)."""
    pieces = read_pieces(vocabulary or default_vocabulary())
    langs, logp = fit(pieces, training_words(spark, docs, **bounds))
    return pickle.dumps((pieces, langs, logp))


def identify(spark: SparkSession, docs: DataFrame, model: bytes, step: int = 64) -> DataFrame:
    """docs with lang_pred and score. The model's size is bounded by the vocabulary and the number of languages."""
    docs = docs.drop("lang_pred", "score")
    shared, at = spark.sparkContext.broadcast(model), docs.columns.index("text")
    schema = docs.schema.jsonValue()
    schema["fields"] = [*schema["fields"], *({"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in (("lang_pred", "string"), ("score", "double")))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("langid")
        own = scorer(shared.value)
        own.clear()
        for batch in batches:
            langs, scores, texts = [], [], batch.column(at)
            for k in range(0, batch.num_rows, step):
                a, b = own.predict(texts.slice(k, step).to_pylist())
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])
        own.clear()

    return docs.mapInArrow(work, type(docs.schema).fromJson(schema))


def held_out(doc_id: Column) -> Column:
    """Documents that training leaves aside; those without an id are not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
