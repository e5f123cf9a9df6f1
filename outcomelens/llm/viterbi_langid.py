"""Language identification of mixed-language text.

Words are scored one by one: hashed letter n-grams (with word boundaries) under a smoothed
model per language. The script of a word narrows the candidates to the languages that were
learned with that script. Viterbi decoding over a document's words with a penalty for every change of
language then labels spans. The document gets the language of most of its words; its score is the
share of words in that language's spans, discounted by how clearly they beat the next language.

Learning reads a bounded, deterministic sample of the labelled rows: about ``SAMPLE_DOCS`` different texts per
language, chosen by a hash of label and text. Copies of a text count once, in the sizes and in the sample. Counts
are summed in Spark. Every label is learned; the model has ``BUCKETS`` numbers of 4 bytes per language (256 KB),
whatever the corpus, and comes to the driver one language at a time. More labels than ``most_languages`` are an
error, never dropped.

Defined results
    ``und`` with score 0 if the text is null, empty or has no letter, or if no language was learned. A text with
    letters always gets a learned language, that with most different texts if no evidence is left. Ties go to the language
    that sorts first. Rows are never joined or grouped, so null ids and repeated rows keep their rows. Extra columns pass
    through whatever their name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import held_out, packed, prepare, query, table

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SAMPLE_DOCS = 1_000
#: A model of so many languages has 256 MB.
MOST_LANGUAGES = 1_000
#: Share of a language's probability that is spread over all n-grams.
UNSEEN = 0.05
#: Cost of a change of language, in nats.
SWITCH = 12.0
#: A word tells at most so many nats for or against a language.
WORD_CAP = 8.0
#: A script is used by a language if it makes up this share of its letters.
SCRIPT_SHARE = 0.01
#: Words whose scores a task keeps, and scores (one per word and language).
CACHE_UNITS = 500_000
CACHE_SCORES = 1 << 24
LONGEST_CACHED = 64

#: First and last code point of the scripts that narrow the candidates.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "ethiopic": ((0x1200, 0x137F),),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x9FFF),),
    "hangul": ((0xAC00, 0xD7AF), (0x1100, 0x11FF)),
}
SCRIPT_NAMES = [*SCRIPTS, "other"]


def script_of(word: str) -> int:
    """Number of the script of the word's first letter."""
    if word[0] <= "\u024f" and word[0].isalpha():
        return 0
    for c in word:
        if c.isalpha():
            point = ord(c)
            for i, ranges in enumerate(SCRIPTS.values()):
                if any(a <= point <= b for a, b in ranges):
                    return i
            break
    return len(SCRIPTS)


def letters_of(unit: str) -> str:
    """The unit in lower case without signs at its ends; empty if it has no letter."""
    if unit.isalpha():
        return unit.lower()
    a, b = 0, len(unit)
    while a < b and not unit[a].isalpha():
        a += 1
    while b > a and not unit[b - 1].isalpha():
        b -= 1
    return unit[a:b].lower()


def grams_of(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order: the bucket of every n-gram (boundaries included) and the place of its word."""
    codes = np.frombuffer("".join([f" {w} " for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    out, rolled = [], np.zeros(len(codes), np.uint64)
    for k in range(1, max(ORDERS) + 1):
        rolled = rolled[: len(codes) - k + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[k - 1 :]
        if k in ORDERS:
            inside = word[: len(rolled)] == word[k - 1 :]
            if k == 1:
                inside &= codes != 32
            mixed = (rolled[inside] + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
            out.append(((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, word[: len(rolled)][inside]))
    return out


# ---- learning --------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pre-summed n-gram counts; scripts are counted below zero."""
    for batch in batches:
        units: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            units.setdefault(lang, Counter()).update(text.split())
        columns: list[tuple[str, int, int]] = []
        for lang, counted in units.items():
            pairs = [(w, n) for u, n in counted.items() if (w := letters_of(u))]
            if not pairs:
                continue
            times = np.array([n for _, n in pairs])
            total = np.zeros(BUCKETS)
            for bucket, word in grams_of([w for w, _ in pairs]):
                total += np.bincount(bucket, times[word], BUCKETS)
            seen = np.flatnonzero(total)
            columns += [(lang, int(g), int(n)) for g, n in zip(seen, total[seen])]
            script = np.bincount([script_of(w) for w, _ in pairs], times, len(SCRIPT_NAMES))
            columns += [(lang, -1 - i, int(n)) for i, n in enumerate(script) if n]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        values = zip(*columns) if columns else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(values, kinds)], ["lang", "gram", "n"])


class LanguageModel:
    """Log probabilities per bucket and language, and which scripts a language uses."""

    def __init__(self, languages: list[str], logp: np.ndarray, scripts: np.ndarray, default: int) -> None:
        self.languages, self.logp, self.scripts, self.default = languages, logp, scripts, default


def sample_of(rows: DataFrame, sizes: dict[str, int], sample_docs: int) -> DataFrame:
    """About ``sample_docs`` different texts of each language; each comes once, however many rows hold it."""
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, sample_docs / v))])
    place = F.pmod(F.col("same"), F.lit(1 << 20)) / float(1 << 20)
    return rows.filter(place < share[F.col("lang")]).dropDuplicates(["lang", "same"])


def learn(
    docs: DataFrame, lang: str = "lang", text: str = "text", sample_docs: int = SAMPLE_DOCS, most_languages: int = MOST_LANGUAGES
) -> LanguageModel:
    """Fit from labelled rows; null labels and texts are not used."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("same", F.xxhash64("lang", "text"))
    # One short row per language: its different texts.
    counted = rows.select("lang", "same").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in counted.limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages in column {lang}; a model holds {BUCKETS * 4} bytes for each")
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool), 0)
    languages = sorted(sizes)
    sample = sample_of(rows, sizes, sample_docs).select("lang", "text")
    summed = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    packed_counts = summed.groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("counts"))
    packed_counts = packed_counts.select("lang", F.col("counts.gram").alias("gram"), F.col("counts.n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)), np.float32)
    scripts = np.zeros((len(SCRIPT_NAMES), len(languages)))
    # At most BUCKETS numbers per language.
    for row in packed_counts.toLocalIterator():
        column = languages.index(row["lang"])
        gram, n = np.array(row["gram"], np.int64), np.array(row["n"], np.float64)
        plain = gram >= 0
        counts[gram[plain], column] = n[plain]
        scripts[-1 - gram[~plain], column] = n[~plain]
    # What was never seen is equally unlikely in every language, however much text each was learned from.
    logp = np.log((1 - UNSEEN) * counts / np.maximum(counts.sum(0, dtype=np.float64), 1) + UNSEEN / BUCKETS).astype(np.float32)
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    return LanguageModel(languages, logp, used & (scripts > 0), int(np.argmax([sizes[x] for x in languages])))


# ---- labelling -------------------------------------------------------------------------


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word under a penalty per change.

    If no stretch of words gains more than half a penalty by another language than the best single
    one, the single language is the best path, since every stretch costs at least half a penalty.
    """
    n, k = scores.shape
    best = int(np.argmax(scores.sum(0)))
    gain = np.cumsum(scores - scores[:, best : best + 1], 0)
    low = np.minimum(np.minimum.accumulate(gain, 0), 0)
    previous = np.vstack((np.zeros((1, k), gain.dtype), low[:-1]))
    if k == 1 or (gain - previous).max() <= switch / 2:
        return np.full(n, best)
    rows = scores.tolist()
    value, came = rows[0], []
    for row in rows[1:]:
        top = max(range(k), key=value.__getitem__)
        jump = value[top] - switch
        came.append([top if v < jump else j for j, v in enumerate(value)])
        value = [(jump if v < jump else v) + s for v, s in zip(value, row)]
    path = [max(range(k), key=value.__getitem__)]
    for back in reversed(came):
        path.append(back[path[-1]])
    return np.array(path[::-1])


class Labeller:
    """A model with the scores of the words a task has met; they go with the task."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.matrix, self.used = np.zeros((1_024, len(self.model.languages)), np.float32), 0

    def score(self, words: list[str]) -> np.ndarray:
        """Nats for each language, 0 for the best, at least ``-WORD_CAP``."""
        scores = np.zeros((len(words), len(self.model.languages)))
        for bucket, word in grams_of(words):
            for j in range(scores.shape[1]):
                scores[:, j] += np.bincount(word, self.model.logp[bucket, j], len(words))
        scores /= len(ORDERS)  # overlapping n-grams repeat each other
        fits = self.model.scripts[[script_of(w) for w in words]]
        scores = np.where(fits, scores, -np.inf)
        scores -= np.where(fits.any(1), scores.max(1), 0.0)[:, None]
        scores[~fits.any(1)] = 0.0
        return np.maximum(scores, -WORD_CAP).astype(np.float32)

    def _learn(self, units: set[str]) -> None:
        worded, words = [], []
        for unit in units:
            word = letters_of(unit)
            if word:
                worded.append(unit)
                words.append(word)
            else:
                self.place[unit] = -1
        if words:
            end = self.used + len(words)
            if end > len(self.matrix):
                grown = np.zeros((max(end, 2 * len(self.matrix)), self.matrix.shape[1]), np.float32)
                grown[: self.used] = self.matrix[: self.used]
                self.matrix = grown
            self.place.update(zip(worded, range(self.used, end)))
            self.matrix[self.used : end] = self.score(words)
            self.used = end

    def label_all(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        cut = [t.split() if t and self.model.languages else [] for t in texts]
        new = set().union(*cut) - self.place.keys()
        # Rows of the matrix count, also those of long units that are forgotten below.
        if self.used and max(self.used, len(self.place)) + len(new) > min(CACHE_UNITS, CACHE_SCORES // len(self.model.languages)):
            self.reset()
            new = set().union(*cut)
        self._learn(new)
        get = self.place.__getitem__
        out = [self._label(np.fromiter(map(get, units), np.int64, len(units))) for units in cut]
        for unit in new:
            if len(unit) > LONGEST_CACHED:
                del self.place[unit]
        return out

    def _label(self, index: np.ndarray) -> tuple[str, float, list[dict]]:
        languages = self.model.languages
        words = np.flatnonzero(index >= 0)
        if not len(words):
            return UNDETERMINED, 0.0, []
        scores = self.matrix[index[words]].astype(np.float64)
        path = viterbi(scores)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [len(path)]))
        spans = [
            {"start": int(words[a]), "n_words": int(words[b - 1] - words[a] + 1), "lang": languages[path[a]]}
            for a, b in zip(edges, edges[1:])
        ]
        if not scores.any():
            return languages[self.model.default], 1.0 / len(languages), spans
        votes = np.bincount(path, minlength=len(languages))
        total = scores.sum(0)
        chosen = min(range(len(languages)), key=lambda j: (-votes[j], -total[j], j))
        own = scores[path == chosen].sum(0)
        others = np.delete(own, chosen)
        margin = own[chosen] - others.max() if len(others) else 50.0
        return languages[chosen], float(votes[chosen] / len(path) / (1.0 + np.exp(-np.clip(margin, -50, 50)))), spans


def _label(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        span = pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())])
        for batch in batches:
            got = labeller.label_all(batch.column("__text").to_pylist())
            columns = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            columns += [pa.array([g[2] for g in got], pa.list_(span))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", "lang_pred", "score", "spans"])

    return run


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", carry=None) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), lang_pred, score, spans (start and length in words, language)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = packed(docs, carry, __text=text)
    shared = spark.sparkContext.broadcast(model)
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        _label(shared), f"doc {kind}, lang_pred string, score double, spans array<struct<start:long,n_words:long,lang:string>>"
    )


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs, model, carry=["doc_id"])
    return found.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score", "spans")
