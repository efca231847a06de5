"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on ordinary text, one on what toxic text has beyond it;
a window that the second helps to compress shorter speaks for toxicity.

1. *Sample.* A bounded number of labelled training rows per class (``Sample``),
   chosen by a hash of the id, with their whole texts, written as a table; two
   thirds of the ids train the dictionaries, the rest calibrates.
2. *Dictionaries.* For the ordinary one, every task trains a dictionary on all
   ordinary windows that it holds, and the driver trains the final one on theirs.
   The toxic one holds stretches of words: Spark counts in how many toxic and
   ordinary texts (copies once) each run of 6 to 8 characters of a word stands,
   with the blanks around the word; those that are more frequent in toxic texts
   by a likelihood ratio are typical, and the dictionary is what they cover of
   toxic words, most frequent last. Words of a language with few toxic rows pass
   that test as soon as they are telling, whatever is frequent elsewhere.
3. *Windows.* A window of the normal text that holds a typical run is compressed
   with the ordinary dictionary and with both in a row; the difference is what
   the toxic one saves. Other windows hold nothing that is typical and count as 0;
   an automaton finds the runs, so most text is never compressed.
4. *Thresholds and score.* Thresholds are the savings that small shares of the
   ordinary calibration windows reach (``Settings.reached``). Per document: how
   many windows and what share of them lie above each, the mean and the largest
   saving. A logistic fit on the calibration rows maps them to a score from 0 to
   1, moved to the share of toxic rows among all training labels. Tasks compress
   the whole calibration texts; a row's counts of each saving reach the driver.

Training, calibration and scoring read whole texts alike, and no column but the
text; the model (dictionaries of some 40 kilobytes, a few thousand runs and a
dozen numbers) goes along with the tasks.

Nulls and edges: a null text is an empty one; texts without words have no
savings and get the score of none; a null id is kept and never used for
training, and repeated rows are scored each; of rows that share a sampled id, the
text with the smallest hash is the sample's; label rows with a null label or id
are left out, repeated labels count as they stand; without labels of both
classes every score is the share of toxic labels (0 without any); an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stored, text_or_empty

#: Characters of a run, with the blanks around its word.
RUN = (6, 8)
NOT_WORD = re.compile(r"[\W_]+")
SCORES = "doc_id long, score double"
#: Distinct runs that a task counts before it hands them on.
RUNS_HELD = 500_000
#: Partitions of the sample's table.
SAMPLE_PARTS = 48


@dataclass(frozen=True)
class Sample:
    """Bound of the labelled sample, whose texts are read whole."""

    rows_per_class: int = 6000


@dataclass(frozen=True)
class Settings:
    window: int = 64
    level: int = 12
    ordinary_bytes: int = 32768
    toxic_bytes: int = 8192
    #: Likelihood ratio (chi-square, one degree) above which a run is typical, and texts that must hold it.
    ratio: float = 20.0
    least_texts: int = 3
    #: Shares of ordinary windows that may reach the thresholds.
    reached: tuple[float, ...] = (0.01, 0.005, 0.002, 0.0005)


def normal(text: str) -> str:
    return NOT_WORD.sub(" ", text.lower()).strip()


def windows(data: bytes, size: int) -> list[bytes]:
    return [data[i:i + size] for i in range(0, len(data), size)]


def runs(text: str) -> set[str]:
    """The runs of all words of a normal text."""
    out = set()
    for word in set(text.split()):
        word = f" {word} "
        for n in range(RUN[0], RUN[1] + 1):
            out.update(word[i:i + n] for i in range(len(word) - n + 1))
    return out


def stretches(text: str, typical: set[str]) -> set[str]:
    """What ``typical`` runs cover of the words of a normal text."""
    out = set()
    for word in set(text.split()):
        word, start, end = f" {word} ", 0, 0
        for i in range(len(word)):
            reach = max((i + n for n in range(RUN[0], RUN[1] + 1) if word[i:i + n] in typical), default=0)
            if reach and i > end:
                if end:
                    out.add(word[start:end])
                start = i
            end = max(end, reach)
        if end:
            out.add(word[start:end])
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too few samples for that, the distinct samples themselves."""
    import zstandard

    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(dict.fromkeys(samples))[:size] or b" " * 8


class Model:
    """Dictionaries, typical runs, thresholds and weights; ``score(text)`` is all that tasks need."""

    def __init__(self, ordinary: bytes, toxic: bytes, typical: list[str], settings: Settings):
        self.ordinary, self.both, self.typical, self.settings = ordinary, ordinary + toxic, typical, settings
        self.thresholds: tuple[float, ...] = (1.0,)
        self.mean = self.scale = self.weights = None
        self._made = None

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def _tools(self):
        import ahocorasick
        import zstandard as z

        automaton = ahocorasick.Automaton()
        for run in self.typical:
            automaton.add_word(run, len(run))
        automaton.make_automaton()
        compress = []
        for content in (self.ordinary, self.both):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=self.settings.level)
            compress.append(z.ZstdCompressor(level=self.settings.level, dict_data=d, write_content_size=False,
                                             write_checksum=False, write_dict_id=False).compress)
        return automaton, *compress

    def savings(self, text: str) -> np.ndarray:
        """What the toxic dictionary saves in each window."""
        self._made = self._made or self._tools()
        automaton, plain, both = self._made
        text, size = f" {normal(text)} ", self.settings.window
        out = np.zeros(-(-len(text) // size))
        held = set()
        if self.typical:
            for last, n in automaton.iter(text):
                held.update((last // size, (last - n + 1) // size))
        for i in held:
            part = text[i * size:(i + 1) * size].encode()
            out[i] = len(plain(part)) - len(both(part))
        return out

    def features(self, savings: np.ndarray, counts: np.ndarray) -> list[float]:
        """Of a text whose windows have these savings so many times."""
        n = counts.sum()
        over = [counts[savings >= t].sum() for t in self.thresholds]
        return [savings @ counts / n, savings.max(), np.log1p(n), *[k / n for k in over], *[np.log1p(k) for k in over]]

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> None:
        """``rows``: (savings, counts) of whole texts."""
        clean = [r for r, y in zip(rows, toxic) if not y]
        at = quantiles(np.concatenate([s for s, _ in clean]), np.concatenate([n for _, n in clean]),
                       [1 - share for share in self.settings.reached])
        # one above the one before at least, so that each says something of its own
        steps: list[float] = []
        for value in at:
            steps.append(max(math.floor(value) + 1.0, steps[-1] + 1 if steps else 1.0))
        self.thresholds = tuple(steps)
        x = np.array([self.features(*r) for r in rows])
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        w = np.zeros(x.shape[1])
        penalty = np.full(len(w), 1.0)
        penalty[0] = 0.0
        for _ in range(50):  # Newton steps of a ridge logistic fit
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w)),
                                   x.T @ (toxic - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def score(self, text: str) -> float:
        savings, counts = np.unique(self.savings(text), return_counts=True)
        x = (np.array(self.features(savings, counts)) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30))))


def quantiles(values: np.ndarray, counts: np.ndarray, shares) -> list[float]:
    """As ``np.quantile`` of every value so many times."""
    values, at = np.unique(values, return_inverse=True)
    ends = np.cumsum(np.bincount(at, counts))
    out = []
    for share in shares:
        place = (ends[-1] - 1) * share
        below, above = (values[np.searchsorted(ends, p, side="right")] for p in (math.floor(place), math.ceil(place)))
        out.append(float(below + (above - below) * (place - math.floor(place))))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: Sample, label_id: str):
    """A table (doc_id, plain, bad, text) and the share of label 1 among all training rows.

    At most ``rows_per_class`` label rows per class are in it; ``plain`` and
    ``bad`` say how many of each an id has.
    """
    known = (pick(labels, doc_id=label_id, y=label).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & train))
    order = F.xxhash64("doc_id")
    chosen = None
    for cls in (0, 1):
        some = known.filter(F.col("y") == cls).orderBy(order, "doc_id").limit(sample.rows_per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    ids = chosen.groupBy("doc_id").agg(F.sum(1 - F.col("y")).cast("int").alias("plain"), F.sum("y").cast("int").alias("bad"))
    # at most 2 x rows_per_class ids, and one text of each
    rows = (docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "plain", "bad")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    share = known.agg(F.avg("y")).first()[0] or 0.0
    # sorted, so that training does not depend on the order in which shuffled rows arrive
    return stored(rows.repartition(SAMPLE_PARTS, "doc_id").sortWithinPartitions("doc_id"), "toxicity-sample"), float(share)


def _counted(rows: DataFrame, made) -> DataFrame:
    """(item, plain, bad): in how many distinct ordinary and toxic texts each item of ``made(normal text)`` is."""
    def count(batches):
        counts = Counter(), Counter()

        def out():
            items = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), *[pa.array([c[g] for g in items], pa.int64()) for c in counts]],
                                              names=["item", "plain", "bad"])

        for batch in batches:
            for plain, bad, text in zip(*[batch.column(c).to_pylist() for c in ("plain", "bad", "text")]):
                items = made(normal(text))
                for c, there in zip(counts, (plain, bad)):
                    if there:
                        c.update(items)
                if len(counts[0]) + len(counts[1]) > RUNS_HELD:
                    yield out()
                    counts = Counter(), Counter()
        yield out()

    return (rows.mapInArrow(count, "item string, plain long, bad long")
            .groupBy("item").agg(F.sum("plain").alias("plain"), F.sum("bad").alias("bad")))


def typical_runs(texts: DataFrame, settings: Settings) -> list[str]:
    """The runs that are more frequent in toxic than in ordinary texts, by their likelihood ratio.

    Best first, and no more than the dictionary has bytes, which they would fill many times over.
    """
    plain, bad = (float(n or 0) for n in texts.agg(F.sum("plain"), F.sum("bad")).first())
    if not plain or not bad:
        return []

    def term(k: Column, n, share: Column) -> Column:
        return F.when(k > 0, k * F.log(share)).otherwise(0.0) + F.when(F.lit(n) - k > 0, (F.lit(n) - k) * F.log1p(-share)).otherwise(0.0)

    k0, k1 = F.col("plain").cast("double"), F.col("bad").cast("double")
    common = (k0 + k1) / (plain + bad)
    ratio = 2 * (term(k1, bad, k1 / bad) + term(k0, plain, k0 / plain) - term(k1, bad, common) - term(k0, plain, common))
    telling = (_counted(texts, runs).filter((F.col("bad") >= settings.least_texts) & (k1 * plain > k0 * bad))
               .select("item", ratio.alias("ratio")).filter(F.col("ratio") > settings.ratio))
    return [r.item for r in telling.orderBy(F.desc("ratio"), "item").limit(settings.toxic_bytes).collect()]


def toxic_dictionary(texts: DataFrame, typical: list[str], size: int) -> bytes:
    """Stretches of toxic words, the most frequent ones last, up to ``size`` bytes."""
    known = set(typical)
    found = _counted(texts.filter("bad > 0"), lambda t: stretches(t, known))
    best = found.orderBy(F.desc("bad"), "item").limit(size).collect()  # each has bytes of its own
    return "".join(r.item for r in reversed(best)).encode()[-size:]


def ordinary_dictionary(rows: DataFrame, size: int) -> bytes:
    """Trained on all ordinary windows: in every task on its own, and on what the tasks found in the driver."""
    def train(batches):
        samples = [piece for batch in batches for text in batch.column("text").to_pylist() for piece in windows(normal(text).encode(), 256)]
        yield pa.RecordBatch.from_arrays([pa.array([_dictionary(samples, size)] if samples else [], pa.binary())], names=["found"])

    found = rows.filter("plain > 0").select("text").mapInArrow(train, "found binary").collect()  # SAMPLE_PARTS at most
    return _dictionary([piece for r in sorted(bytes(r.found) for r in found) for piece in windows(r, 256)], size)


def calibration_rows(rows: DataFrame, model: Model) -> list:
    """Per row: doc_id, plain, bad, and how many windows of the whole text have each saving."""
    def measure(batches):
        for batch in batches:
            made = [np.unique(model.savings(t), return_counts=True) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "plain", "bad")], pa.array([v.tolist() for v, _ in made], pa.list_(pa.float64())),
                 pa.array([n.tolist() for _, n in made], pa.list_(pa.int64()))], names=["doc_id", "plain", "bad", "savings", "counts"])

    return rows.mapInArrow(measure, "doc_id long, plain int, bad int, savings array<double>, counts array<long>").collect()


def train_model(rows: DataFrame, share: float, settings: Settings) -> Model | None:
    """The model of a labelled sample; None without both classes in both parts."""
    held = rows.select("doc_id", "plain", "bad").collect()
    ids = sorted({(hash(r.doc_id * 0x9E3779B97F4A7C15 & (1 << 61) - 1), r.doc_id, r.bad > 0) for r in held})
    parts: dict[int, bool] = {}  # whether an id calibrates
    for cls in (False, True):
        parts |= {doc_id: i % 3 == 2 for i, (_, doc_id, _) in enumerate(x for x in ids if x[2] == cls)}
    plain, bad = ([sum(r[cls] for r in held if parts[r.doc_id] == later) for later in (False, True)] for cls in ("plain", "bad"))
    if not all(plain + bad):
        return None
    later = F.broadcast(rows.sparkSession.createDataFrame([(d,) for d, p in parts.items() if p], "doc_id long"))
    trains, calibrates = (rows.join(later, "doc_id", how) for how in ("left_anti", "left_semi"))
    texts = trains.groupBy("text").agg(F.max((F.col("plain") > 0).cast("int")).alias("plain"),
                                       F.max((F.col("bad") > 0).cast("int")).alias("bad"))
    typical = typical_runs(texts, settings)
    model = Model(ordinary_dictionary(trains, settings.ordinary_bytes), toxic_dictionary(texts, typical, settings.toxic_bytes),
                  typical, settings)
    found = sorted(calibration_rows(calibrates, model))
    x = [(np.array(r.savings), np.array(r.counts)) for r in found]
    model.fit([v for cls in ("plain", "bad") for v, r in zip(x, found) for _ in range(r[cls])],
              np.repeat([0, 1], [plain[1], bad[1]]))
    if 0 < share < 1:
        model.weights[0] += math.log(share / (1 - share)) - math.log(bad[1] / plain[1])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, *, train: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_id: str = "doc_id", label_col: str = "toxic", sample: Sample = Sample(),
                   settings: Settings = Settings()) -> DataFrame:
    """(doc_id, score) per row. ``train`` is a condition on ``doc_id``: labels of other rows are not looked at."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    some, share = labelled_sample(rows, labels, label_col, train, sample, label_id)
    model = train_model(some, share, settings)
    if model is None:
        return rows.select("doc_id", F.lit(share).alias("score"))

    def score(batches):
        for batch in batches:
            made = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(score, SCORES)
