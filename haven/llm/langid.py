"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability in a language is the sum, over all ways to cut it into
pieces, of the products of their probabilities (the forward algorithm); a text's
is the product over its words.  Probabilities come from expectation
maximisation over a bounded sample of labelled documents: forward and backward
sums give each piece's expected count, again over all segmentations.

Words are scored in batches: one numpy step per (end, length) for all words of
about one size at once.  Words over ``LONG_WORD`` characters, such as the runs of
scripts written without spaces, are trained on and scored one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from haven.llm.common import written

UNKNOWN_WORD = "und"
#: Labelled documents per language that the model is fitted on (the smallest hashes of their ids).
TRAIN_DOCS = 400
EM_ROUNDS = 2
#: Texts whose words are scored at once: enough for wide numpy steps, and their word lists stay small.
STEP_TEXTS = 500
SPACE = "▁"
#: Words longer than this are handled alone, with rescaling or in logarithms.
LONG_WORD = 32
#: Probability of a character that no piece covers, in every language.
UNKNOWN_CHAR = 1e-9
LETTER = re.compile(r"[^\W\d_]")  # numerals such as one half included, hence ``has_letter``
WORD = re.compile(r"\S+")


class Vocabulary:
    """Pieces as ids; ids of all substrings of many words at once by hash lookup."""

    def __init__(self, pieces: list[str]):
        self.pieces = sorted(set(pieces))
        self.ids = {p: i for i, p in enumerate(self.pieces)}
        self.width = max(map(len, self.pieces))
        self.base = np.uint64(0x100000001B3)
        h = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(h)
        self.sorted, self.order = h[order], order.astype(np.int32)
        self.present = np.zeros(1 << 20, bool)  # by the top bits: most substrings are no piece
        self.present[self.sorted >> np.uint64(44)] = True
        if len(np.unique(h)) != len(h):
            raise ValueError("piece hashes collide")

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self.base) + (ord(c) + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        return h ^ len(piece)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as model_pb
        model = model_pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        return cls([p.piece for p in model.pieces if p.type == 1])

    def spans(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(end, length, piece id or -1 per word) over all substrings, words of equal length; ends ascend."""
        n = len(words[0])
        codes = np.array([list(map(ord, w)) for w in words], np.uint64).reshape(len(words), n)
        codes = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        hashes: list[np.ndarray] = []  # per start still open, the hash of start..end
        for end in range(1, n + 1):
            hashes = [h * self.base + codes[:, end - 1] for h in hashes[-(self.width - 1):]] + [codes[:, end - 1]]
            for i, h in enumerate(hashes):
                length = len(hashes) - i
                x = h ^ np.uint64(length)
                ids = np.full(len(x), -1, np.int32)
                maybe = np.flatnonzero(self.present[x >> np.uint64(44)])
                if len(maybe):
                    y = x[maybe]
                    at = np.minimum(np.searchsorted(self.sorted, y), len(self.sorted) - 1)
                    ids[maybe] = np.where(self.sorted[at] == y, self.order[at], -1)
                yield end, length, ids


class LanguageModel:
    """Languages and their piece probabilities (pieces x languages)."""

    def __init__(self, vocabulary: Vocabulary, languages: list[str], probability: np.ndarray):
        self.vocabulary, self.languages = vocabulary, languages
        # one more row: no piece
        self.p = np.vstack([probability, np.zeros((1, len(languages)))])

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (rows) in each language, all segmentations summed."""
        out = np.zeros((len(words), len(self.languages)))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, at in by_length.items():
            if n > LONG_WORD:
                for i in at:
                    out[i] = self._long(words[i])
                continue
            alpha = [np.ones((len(at), len(self.languages)))]
            for end, length, ids in self.vocabulary.spans([words[i] for i in at]):
                if len(alpha) <= end:
                    alpha.append(np.zeros_like(alpha[0]))
                if length == 1:
                    alpha[end] += alpha[end - 1] * np.where((ids >= 0)[:, None], self.p[ids], UNKNOWN_CHAR)
                    continue
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    alpha[end][hit] += alpha[end - length][hit] * self.p[ids[hit]]
            out[at] = np.log(alpha[n])
        return out

    def _long(self, word: str) -> np.ndarray:
        ids, width = self.vocabulary.ids, self.vocabulary.width
        log, alpha = np.zeros(len(self.languages)), [np.ones(len(self.languages))]
        for end in range(1, len(word) + 1):
            now = alpha[-1] * (self.p[ids[word[end - 1]]] if word[end - 1] in ids else UNKNOWN_CHAR)
            for length in range(2, min(len(alpha), width) + 1):
                i = ids.get(word[end - length: end])
                if i is not None:
                    now = now + alpha[-length] * self.p[i]
            scale = now.copy()
            log += np.log(scale)
            alpha = [a / scale for a in alpha[-width:]] + [now / scale]
        return log

    def expected_counts(self, words: list[str], weights: list[float], language: int) -> np.ndarray:
        """Expected count of each piece over all segmentations of weighted words
        (of one length, or all over ``LONG_WORD``)."""
        n, p = len(words[0]), self.p[:, language]
        if n > LONG_WORD:
            counts = np.zeros(len(p))
            for word, weight in zip(words, weights, strict=True):
                self._long_counts(word, weight, p, counts)
            return counts[:-1]
        spans = list(self.vocabulary.spans(words))
        alpha, beta = np.zeros((n + 1, len(words))), np.zeros((n + 1, len(words)))
        alpha[0] = beta[n] = 1
        prob = [np.where(i >= 0, p[i], UNKNOWN_CHAR if length == 1 else 0.0) for _, length, i in spans]
        for (end, length, _), q in zip(spans, prob, strict=True):
            alpha[end] += alpha[end - length] * q
        for (end, length, _), q in zip(reversed(spans), reversed(prob), strict=True):
            beta[end - length] += beta[end] * q
        counts = np.zeros(len(self.p))
        w = np.array(weights) / alpha[n]
        for (end, length, i), q in zip(spans, prob, strict=True):
            np.add.at(counts, i, alpha[end - length] * q * beta[end] * w)  # id -1 falls on the last row
        return counts[:-1]

    def _long_counts(self, word: str, weight: float, p: np.ndarray, counts: np.ndarray) -> None:
        """Add one word's expected counts; forward and backward sums are kept as logarithms."""
        ids, width, n = self.vocabulary.ids, self.vocabulary.width, len(word)

        def log_sum(x: list[float]) -> float:
            top = max(x)
            return top + math.log(sum(math.exp(v - top) for v in x))

        ends: list[list[tuple[int, int, float]]] = [[]]  # per end: (start, piece id, log probability)
        starts: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        alpha, beta = [0.0], [0.0] * (n + 1)
        for end in range(1, n + 1):
            here = []
            for start in range(max(0, end - width), end):
                i = ids.get(word[start:end], -1)
                if i >= 0 and p[i] > 0:
                    here.append((start, i, math.log(p[i])))
                elif i < 0 and start == end - 1:
                    here.append((start, -1, math.log(UNKNOWN_CHAR)))
            ends.append(here)
            for start, _, q in here:
                starts[start].append((end, q))
            alpha.append(log_sum([alpha[start] + q for start, _, q in here]))
        for start in range(n - 1, -1, -1):
            beta[start] = log_sum([beta[end] + q for end, q in starts[start]])
        for end in range(1, n + 1):
            for start, i, q in ends[end]:
                counts[i] += weight * math.exp(alpha[start] + q + beta[end] - alpha[n])


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def split_words(text: str) -> list[str]:
    return [SPACE + w for w in WORD.findall(text.lower())]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary.from_file(path)
    return _VOCABULARIES[path]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for w in split_words(text):
                seen[lang, w] += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen]), pa.array([k[1] for k in seen]),
                                              pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])


def held_out(doc_id) -> F.Column:
    """Documents whose crc32(doc_id as text) mod 5 is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, model_path: str, train_docs: int = TRAIN_DOCS, rounds: int = EM_ROUNDS) -> LanguageModel:
    """Fit on at most ``train_docs`` labelled, not held-out documents per language:
    those with the smallest hashes of id.  A hash bound from the language's own
    number of documents leaves a few times ``train_docs`` candidates to rank,
    however many rows and splits there are.

    What reaches the driver is the piece table: at most (vocabulary x
    languages) numbers.  Words of any length are trained on, so every language of
    the sample with a word at all is known.  Documents without text or lang teach
    nothing; with no labelled document the model knows no language.
    """
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "doc_id", "lang", "text", F.xxhash64("text").alias("th"))
    usable = usable.withColumn("at", F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 40)))
    # documents per language, by id: copies of one row do not narrow the bound; a number a language
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.approx_count_distinct("at").alias("n")).collect()}
    bounds = [F.lit(x) for lang, n in sizes.items()
              for x in (lang, float(1 << 40) * min(1.0, 4 * train_docs / n if n > 8 * train_docs else 1.0))]
    bound = F.create_map(*bounds)[F.col("lang")] if bounds else F.lit(0.0)
    near = usable.select("doc_id", "lang", "th", "at").filter(F.col("at") < bound).distinct()
    order = W.partitionBy("lang").orderBy("at", "doc_id", "th")
    chosen = (near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= train_docs)
              .select(F.col("doc_id").alias("d"), F.col("lang").alias("l"), F.col("th").alias("t")))
    # at most train_docs rows a language: a bounded side
    sample = usable.join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("lang") == F.col("l"))
                         & (F.col("th") == F.col("t")), "left_semi")
    counts = (sample.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    counts = written(counts, "langid-words")
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    vocab = vocabulary(model_path)
    size, at = len(vocab.pieces), {lang: i for i, lang in enumerate(languages)}
    probability = np.full((size, len(languages)), 1.0 / size)
    spark = docs.sparkSession
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast(probability)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = LanguageModel(vocabulary(model_path), languages, shared.value)
            for batch in batches:
                groups: dict[tuple[str, int], tuple[list[str], list[float]]] = {}
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                    ws, ns = groups.setdefault((lang, min(len(word), LONG_WORD + 1)), ([], []))
                    ws.append(word)
                    ns.append(float(n))
                total: dict[str, np.ndarray] = {}
                for (lang, _), (ws, ns) in groups.items():
                    got = model.expected_counts(ws, ns, at[lang])
                    total[lang] = total[lang] + got if lang in total else got
                for lang, got in total.items():
                    hit = np.flatnonzero(got > 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(hit), pa.string()), pa.array(hit, pa.int32()),
                         # whole numbers, so that the sum does not depend on its order
                         pa.array(np.round(got[hit] * 2 ** 20).astype(np.int64))], names=["lang", "piece", "n"])

        got = (counts.mapInArrow(expect, "lang string, piece int, n long").groupBy("lang", "piece")
               .agg(F.sum("n").alias("n")).toPandas())
        table = np.zeros((size, len(languages)))
        table[got["piece"].to_numpy(), got["lang"].map(at).to_numpy()] = got["n"].to_numpy() / 2 ** 20
        table += 0.05  # every piece stays possible in every language
        probability = table / table.sum(axis=0)
    return LanguageModel(vocab, languages, probability)


def predict(docs: DataFrame, model: LanguageModel, model_path: str, carry: list[str] | None = None,
            memory: int = 200_000) -> DataFrame:
    """Per document row: doc_id, lang_pred, score (posterior with equal priors),
    after the input columns ``carry``.  Only the text decides.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text when the model knows no language.  Ties go to the first language by
    name; repeats and null ids pass through; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    languages = model.languages
    shared = spark.sparkContext.broadcast(model.p[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(vocabulary(model_path), languages, shared.value)
        young: dict[str, int] = {}
        table = np.zeros((0, len(languages)))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            pred, score = [], []
            for lo in range(0, len(texts), STEP_TEXTS):
                words = [split_words(t) if t is not None and languages and has_letter(t) else None for t in texts[lo: lo + STEP_TEXTS]]
                fresh = list({w for ws in words if ws for w in ws if w not in young})
                if len(young) + len(fresh) > memory:  # bounded: start anew
                    young.clear()
                    table = table[:0]
                    fresh = list({w for ws in words if ws for w in ws})
                if fresh:
                    young.update(zip(fresh, range(len(young), len(young) + len(fresh)), strict=True))
                    table = np.vstack([table, own.word_scores(fresh)])
                for ws in words:
                    if ws is None:
                        pred.append(UNKNOWN_WORD)
                        score.append(0.0)
                        continue
                    total = table[[young[w] for w in ws]].sum(axis=0)
                    best = int(np.argmax(total))
                    pred.append(languages[best])
                    score.append(float(1.0 / np.exp(total - total[best]).sum()))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*names, "lang_pred", "score"])

    kept = docs.select(*dict.fromkeys(["doc_id", *(carry or []), "text"]))
    out_schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                               T.StructField("score", T.DoubleType())])
    result = kept.mapInArrow(run, out_schema)
    return result if carry else result.select("doc_id", "lang_pred", "score")

