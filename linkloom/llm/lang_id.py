"""Language ID: word-first backoff.

Word counts per language come from all labelled training texts; the model is
the ``vocabulary`` most frequent words of each language with their counts in all
languages, so its size (and what is broadcast) is bounded by that parameter.  A
known word scores its log frequency among all training words of each language.  An unseen word falls back to its character
n-grams: the longest order of which the model knows any, down to single
characters.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import as_array, owner, portions, split_words

#: Words kept per language (bounds the model).
VOCABULARY = 20_000
#: Shards of a language's words when the most frequent are chosen.
SHARDS = 64
#: Character n-gram orders, longest first; words get a mark at both ends.
ORDERS = (5, 4, 3, 2, 1)
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(token: str) -> list[str]:
    return _LETTERS.findall(token.lower())


def train(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang",
          vocabulary: int = VOCABULARY) -> dict:
    """Word counts per language over the rows where ``training`` holds and
    text and language are not null: ``{"langs": [...], "words": {word:
    [count per language]}}``, and if anything was learned, over the words that are
    not kept as well, ``totals`` (occurrences per language) and ``distinct``."""
    rows = docs.where(training).select(F.col(lang_col).cast("string"), F.col(text_col)).na.drop()

    def count(batches):
        for batch in chain.from_iterable(portions(b, 1) for b in batches):
            words, starts = split_words(as_array(batch.column(1)))
            lang = as_array(batch.column(0)).dictionary_encode()
            of = lang.indices.to_numpy()[owner(starts)]
            coded = words.dictionary_encode()
            pairs, n = np.unique(of.astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy(),
                                 return_counts=True)
            tokens, names = coded.dictionary.to_pylist(), lang.dictionary.to_pylist()
            total: dict = defaultdict(int)
            for p, c in zip(pairs.tolist(), n.tolist()):
                for w in letter_words(tokens[p % len(tokens)]):
                    total[names[p // len(tokens)], w] += c
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
                 pa.array(list(total.values()), pa.int64())], names=["lang", "word", "n"])

    counts = rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    # the best of each shard first, so that no task sorts all words of a language
    best = counts
    for shard in (F.pmod(F.xxhash64("word"), F.lit(SHARDS)), F.lit(0)):
        top = Window.partitionBy("lang", "shard").orderBy(F.desc("n"), "word")
        best = (best.withColumn("shard", shard).withColumn("at", F.row_number().over(top))
                .where(F.col("at") <= vocabulary).select("lang", "word", "n"))
    # a word kept for one language has its counts in all
    kept = counts.join(F.broadcast(best.select("word").distinct()), "word", "left_semi").collect()
    sums = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sums)
    words: dict = {}
    for r in kept:
        words.setdefault(r.word, [0] * len(langs))[langs.index(r.lang)] = r.n
    if not langs:
        return {"langs": langs, "words": words}
    return {"langs": langs, "words": words, "totals": [sums[x] for x in langs],
            "distinct": counts.select("word").distinct().count()}


class Scorer:
    """Log frequencies of words and n-grams: a row of ``table`` each, a column per
    language."""

    def __init__(self, model: dict):
        self.langs, words = model["langs"], model["words"]
        grams: list[dict] = [defaultdict(lambda: np.zeros(len(self.langs))) for _ in ORDERS]
        for word, count in words.items():
            count = np.array(count, float)
            for known, order in zip(grams, ORDERS):
                for g in self.grams(word, order):
                    known[g] += count
        tables: list[np.ndarray] = [np.empty((0, len(self.langs)))]
        whole = np.array(model["totals"]) + 0.5 * model["distinct"] if "totals" in model else None
        self.words = self.rows(words, tables, whole)
        self.orders = [self.rows(g, tables) for g in grams]
        self.table = np.concatenate(tables)

    @staticmethod
    def grams(word: str, order: int) -> list[str]:
        marked = f"_{word}_" if order > 1 else word
        return [marked[i:i + order] for i in range(len(marked) - order + 1)]

    @staticmethod
    def rows(counts: dict, tables: list[np.ndarray], whole: np.ndarray | None = None) -> dict[str, int]:
        """Add the logs of the counts' shares of the whole (by default their sum) to the
        tables; the row of each key."""
        first = sum(map(len, tables))
        if counts:
            table = np.array(list(counts.values()), float) + 0.5
            tables.append(np.log(table / (table.sum(axis=0) if whole is None else whole)))
        return dict(zip(counts, range(first, first + len(counts))))

    def word(self, word: str) -> list[int]:
        """The rows whose mean is the word's score."""
        if (known := self.words.get(word)) is not None:
            return [known]
        for rows, order in zip(self.orders, ORDERS):
            if found := [rows[g] for g in self.grams(word, order) if g in rows]:
                return found
        return []

    def tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each token has a letter, and its score in each language."""
        letters = np.zeros(len(tokens), bool)
        rows: list[int] = []
        sizes: list[int] = []
        of: list[int] = []
        for i, token in enumerate(tokens):
            for w in letter_words(token):
                letters[i] = True
                found = self.word(w)
                if found:
                    rows += found
                    sizes.append(len(found))
                    of.append(i)
        size = np.array(sizes, np.int64)
        weight, place = np.repeat(1 / size, size), np.repeat(np.array(of, np.int64), size)
        each = np.empty((len(tokens), len(self.langs)))
        for k in range(len(self.langs)):
            each[:, k] = np.bincount(place, weights=self.table[rows, k] * weight, minlength=len(tokens))
        return letters, each


def _scorer(box: dict) -> Scorer:
    """The process keeps its copy of what is broadcast from task to task, and the scorer
    with it."""
    if "scorer" not in box:
        box["scorer"] = Scorer(box["model"])
    return box["scorer"]


def _predict(scorer: Scorer, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    words, starts = split_words(texts)
    n, langs = len(starts) - 1, len(scorer.langs)
    total, letters = np.zeros((n, langs)), np.zeros(n, bool)
    if not langs:
        return [UNDETERMINED] * n, np.zeros(n)
    if len(words):
        coded = words.dictionary_encode()
        lettered, each = scorer.tokens(coded.dictionary.to_pylist())
        at, of = coded.indices.to_numpy(), owner(starts)
        for k in range(langs):
            total[:, k] = np.bincount(of, weights=each[at, k], minlength=n)
        letters = np.bincount(of, weights=lettered[at], minlength=n) > 0
    best = total.argmax(axis=1)
    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return ([scorer.langs[b] if x else UNDETERMINED for b, x in zip(best, letters)],
            np.where(letters, score, 0.0))


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of each whole text: ``doc_id, lang_pred, score`` (the share of
    the language's likelihood among all learned languages, 0 to 1).

    ``und`` with score 0 if the text is null or has no letter, or if nothing
    was learned.  Ties go to the first language by name.  One row per input row;
    other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        scorer = _scorer(shared.value)
        for batch in chain.from_iterable(portions(b, 1) for b in batches):
            lang, score = _predict(scorer, as_array(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: dict, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """The input rows, with their own columns, whose language is one of the
    learned ones with a score of at least ``min_score``.  By default only texts go that are
    null, have no letter, or of which the model knows no word and no part of one, so that all of several
    languages score alike; short clean texts can have low scores."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})
    place = docs.columns.index(text_col)

    def run(batches):
        scorer = _scorer(shared.value)
        for batch in chain.from_iterable(portions(b, place) for b in batches):
            lang, score = _predict(scorer, as_array(batch.column(place)))
            known = score * len(scorer.langs) > 1 + 1e-9 if len(scorer.langs) > 1 else score > 0
            keep = (score >= min_score) & known & np.array([x != UNDETERMINED for x in lang], bool)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
