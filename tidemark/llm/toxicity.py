"""Toxicity by compression distance: windows of a text against zstandard dictionaries of toxic and ordinary text."""

import bisect
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from .common import bare, flushed, rows_of, settle_text

#: Most labelled rows of each class that a model is fitted on. Rows are taken in the order of a hash of their id, whatever the
#: table's size, and each with its whole text.
SAMPLE_ROWS = 3000
#: Words of a window, bytes of each dictionary's shared and own part, and of the shared text put ahead of windows.
WINDOW = 8
SHARED_BYTES, OWN_BYTES, BALLAST = 6_000, 1_500, 64
#: Texts that a segment must stand in to be counted at all; fewer prove nothing.
LEAST_TEXTS = 4
#: Times by which a segment's share of one class's texts exceeds the other's if it marks the class.
LEAST_LIFT = 20
#: Compressed bytes by which a window must be shorter under the toxic dictionary to count.
STEPS = (2, 3, 4, 5)
FEATURES = 3 + 2 * len(STEPS)
#: Parts of the sample that calibrate in turn, and the weight of the ridge.
FOLDS, RIDGE = 4, 3.0

_LETTERS = re.compile(r"[^\W\d_]+")


def in_training(doc_id):
    """Rows whose labels may be learnt from: CRC-32 of the id's text is not 0 modulo 5."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 != 0


def windows(text, size=WINDOW):
    """The whole text, lower-cased, in windows of ``size`` words with a space at either end."""
    words = text.lower().split()
    return [(" " + " ".join(words[i:i + size]) + " ").encode("utf-8", "surrogatepass") for i in range(0, len(words), size)]


def sketch(text, size=4):
    """Minima of shingle hashes under ``size`` permutations."""
    words = text.lower().split()
    hashes = np.array([zlib.crc32(" ".join(words[i:i + 5]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(words) - 4))], np.uint64)
    return [int(((hashes * np.uint64(2 * k + 2654435761) + np.uint64(k * 40503)) % np.uint64(4294967291)).min()) for k in range(size)]


def without_copies(sketches):
    """Positions of the sketches of which no earlier one shares a minimum; copies would count one author's words many times."""
    seen, out = [set() for _ in range(4)], []
    for n, least in enumerate(sketches):
        if not any(x in s for x, s in zip(least, seen)):
            out.append(n)
        for x, s in zip(least, seen):
            s.add(x)
    return out


def _segments(text):
    """Whole words and beginnings of words, as they stand in a window."""
    out = set()
    for w in set(_LETTERS.findall(text.lower())):
        if len(w) > 2:
            out.add(f" {w} ")
            out.update(" " + w[:k] for k in range(4, min(len(w), 8)))
    return out


def _strengths(a, n, b, m):
    """Signed log-likelihood ratio of each segment's counts ``a`` in ``n`` toxic and ``b`` in ``m`` ordinary texts, above zero in
    toxic text, and little where one class's share is less than ``LEAST_LIFT`` times the other's; and the frequency in both."""
    n, m, ratio = max(n, 1), max(m, 1), {}
    for w in a.keys() | b.keys():
        x, y = a.get(w, 0), b.get(w, 0)
        if not x and not y:
            continue
        both = (x + y) / (n + m)
        g = 2 * sum(k * math.log(k / (size * both)) for k, size in ((x, n), (y, m)) if k)
        lift = (x + 0.1) / n / ((y + 0.1) / m)
        ratio[w] = g if lift >= LEAST_LIFT else -g if 1 / lift >= LEAST_LIFT else 3.84 * (lift > 2)
    return ratio, {w: a.get(w, 0) / n + b.get(w, 0) / m for w in ratio}


def _packed(segments, room):
    """Segments, strongest last and so nearest to the window, in at most ``room`` bytes; none inside or on top of another."""
    out, used, joined, stems = [], 0, "", set()
    for s in segments:
        size = len(s.encode())
        if used + size > room:
            break
        if s not in joined and not any(s[:k] in stems for k in range(4, len(s))):
            out.append(s)
            stems.add(s)
            used += size
            joined += s
    return "".join(reversed(out)).encode() or b" "


def _likeness(a, b):
    """Length of the common beginning."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _closest(marks, vocabulary):
    """For each mark the words of ``vocabulary`` that begin and that end most like it."""
    ahead, back = sorted(vocabulary), sorted(w[::-1] for w in vocabulary)
    out = []
    for mark in marks:
        for words, key, turned in ((ahead, mark.strip(), False), (back, mark.strip()[::-1], True)):
            at = bisect.bisect_left(words, key)
            near = max(words[max(0, at - 1):at + 1], key=lambda w: _likeness(w, key), default=None)
            if near is not None and _likeness(near, key) >= 3:
                out.append(f" {near[::-1] if turned else near} ")
    return list(dict.fromkeys(out))


def train_dictionaries(a, n, b, m, least=35.0):
    """Bytes of the toxic and of the ordinary dictionary, from segment counts ``a`` in ``n`` toxic and ``b`` in ``m`` ordinary texts.

    The toxic one ends, nearest to the window, in the words and beginnings of words whose document counts stand out in
    toxic text by a log-likelihood ratio of ``least`` or more; the ordinary one in what stands out there and in the
    ordinary words most like the toxic marks, so that a window that only resembles a mark is as short under
    either. Before that both hold what the classes share, at the same distance.
    """
    ratio, frequency = _strengths(a, n, b, m)
    own = [w for w in sorted(ratio, key=lambda w: (-ratio[w] * (len(w) - 3), w)) if ratio[w] >= least]  # by evidence and bytes saved
    other = [w for w in sorted(ratio, key=lambda w: (ratio[w], -len(w), w)) if ratio[w] <= -least]
    marked = {*own, *other}
    plain = {w.strip() for w in frequency if w.endswith(" ") and ratio[w] < 3.84}  # no toxic word at a twentieth's chance
    shared = _packed([w for w in sorted(frequency, key=lambda w: (-frequency[w], w)) if w not in marked], SHARED_BYTES)
    ends = _packed(own, OWN_BYTES), _packed(other[:len(other) // 2] + _closest(own, plain) + other[len(other) // 2:], OWN_BYTES)
    return tuple(shared + e.rjust(OWN_BYTES, b"\n") for e in ends)


class Lengths:
    """Compressed length of a window under one dictionary."""

    def __init__(self, content):
        # text that both dictionaries hold goes ahead of each window: a block that does not shrink would be stored as it is
        self.ahead = content[:BALLAST]
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        # a greedy search with small tables: it finds every match of four bytes and costs little to start for each window
        parameters = zstandard.ZstdCompressionParameters(
            window_log=15, hash_log=13, chain_log=13, search_log=4, min_match=4, strategy=zstandard.STRATEGY_GREEDY,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        dictionary.precompute_compress(compression_params=parameters)
        self.compress = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress

    def of(self, windows_):
        compress, ahead = self.compress, self.ahead
        return np.fromiter((len(compress(ahead + w)) for w in windows_), np.int64, len(windows_))


@dataclass
class Model:
    """Two dictionaries, and the calibrated weights of the window statistics."""

    toxic: bytes
    ordinary: bytes
    weights: tuple
    centre: tuple
    scale: tuple

    def __post_init__(self):
        self._pair = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}

    def __setstate__(self, state):
        self.__dict__.update(state, _pair=None)

    def features(self, text):
        """Largest and mean saving of bytes in a window under the toxic dictionary, how many windows save how much, in number and in
        share, and how many there are."""
        if self._pair is None:
            self._pair = Lengths(self.toxic), Lengths(self.ordinary)
        own = windows(text or "")
        if not own:
            return [0.0] * FEATURES
        saved = self._pair[1].of(own) - self._pair[0].of(own)
        least = [int((saved >= s).sum()) for s in STEPS]
        return [float(saved.max()), float(saved.mean()), *map(math.log1p, least), *(n / len(own) for n in least), math.log1p(len(own))]

    def score(self, text):
        x = (np.array(self.features(text)) - self.centre) / self.scale
        z = float(self.weights[0] + np.dot(self.weights[1:], x))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x, y, ridge=RIDGE, rounds=50):
    """Ridge logistic regression by Newton steps; the first weight is the unpenalised intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fold(text):
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % FOLDS


def _trained(counts, sizes, features_of, class_ratio=None):
    """A model from the segment counts and the numbers of texts of each class and fold.

    ``features_of`` takes one model for each fold, trained on the other folds, and gives (class, features) of every text under its fold's. Thresholds
    are thus calibrated on texts that the dictionaries in use did not see. ``class_ratio`` is toxic to ordinary rows in the population, if the
    samples' ratio differs.
    """
    totals, sizes_of = [sum(own, Counter()) for own in counts], [sum(own) for own in sizes]
    blank = (0.0,) * (1 + FEATURES)
    if not all(sizes_of):  # one class or none: its share, whatever the text
        prior = (sizes_of[0] + 0.5) / (sum(sizes_of) + 1)
        return Model(b" ", b" ", (math.log(prior / (1 - prior)), *blank[1:]), blank[1:], (1.0,) * FEATURES)
    models = []
    for f in range(FOLDS):
        rest = [value for k in (0, 1) for value in (totals[k] - counts[k][f], sizes_of[k] - sizes[k][f])]
        models.append(Model(*train_dictionaries(*rest), blank, (0.0,), (1.0,)))
    found = features_of(models)
    x, y = np.array([r[1] for r in found], float).reshape(-1, FEATURES), np.array([1.0 - r[0] for r in found])
    centre, scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    weights = _logistic((x - centre) / scale, y)
    if class_ratio:
        weights[0] += math.log(class_ratio * (1 - y.mean()) / y.mean())
    return Model(*train_dictionaries(totals[0], sizes_of[0], totals[1], sizes_of[1]), tuple(weights), tuple(centre), tuple(scale))


def fit_texts(toxic, ordinary, class_ratio=None):
    """A model from lists of texts."""
    classes = []
    for texts in (toxic, ordinary):
        texts = list(dict.fromkeys(t or "" for t in texts))
        classes.append([texts[n] for n in without_copies(map(sketch, texts))])
    folds = [[[t for t in texts if _fold(t) == f] for f in range(FOLDS)] for texts in classes]
    counts = [[Counter(s for t in texts for s in _segments(t)) for texts in own] for own in folds]
    often = sum((c for own in counts for c in own), Counter())
    counts = [[Counter({s: n for s, n in c.items() if often[s] >= LEAST_TEXTS}) for c in own] for own in counts]
    return _trained(counts, [[len(texts) for texts in own] for own in folds],
                    lambda models: [(k, models[f].features(t)) for k in (0, 1) for f in range(FOLDS) for t in folds[k][f]], class_ratio)


def _per_row(rows, names, types, function):
    """Rows of ``function(class, key, text)`` for each row of a sample, in tasks."""
    schema = pa.schema(list(zip(names, types)))

    def run(batches):
        for batch in batches:
            yield from flushed((found for k, key, text in rows_of(batch, "class", "key", "text") for found in function(k, key, text)), schema)

    kinds = {pa.int32(): "int", pa.string(): "string", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.float64()): "array<double>"}
    return rows.mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in zip(names, types)))


def _sample_counts(sample):
    """Segment counts of each class and fold, of segments in ``LEAST_TEXTS`` texts or more, and the numbers of texts."""
    def segments(k, key, text):
        fold = _fold(text)
        yield k, fold, None
        for s in _segments(text):
            yield k, fold, s

    cells = [(k, f) for k in (0, 1) for f in range(FOLDS)]
    each = _per_row(sample, ["class", "fold", "segment"], [pa.int32(), pa.int32(), pa.string()], segments)
    counted = each.groupBy("segment").agg(*[F.count_if((F.col("class") == k) & (F.col("fold") == f)).alias(f"n{k}{f}") for k, f in cells], F.count("*").alias("n"))
    counts, sizes = [[Counter() for _ in range(FOLDS)] for _ in (0, 1)], [[0] * FOLDS for _ in (0, 1)]
    for row in counted.where(F.col("segment").isNull() | (F.col("n") >= LEAST_TEXTS)).drop("n").collect():
        for (k, f), n in zip(cells, row[1:]):
            if row[0] is None:
                sizes[k][f] = n
            elif n:
                counts[k][f][row[0]] = n
    return counts, sizes


def fit(docs, labels, sample_rows=SAMPLE_ROWS, id_col="doc_id", text_col="text", label_col="toxic"):
    """A model from the labelled rows that may be learnt from.

    The sample is at most ``sample_rows`` rows of each class, by hash order of the id, with their whole texts. Tasks sketch the texts,
    count their segments and measure their windows; only sketches, counts of segments and statistics of windows reach the driver, all bounded by the sample.
    Of an id that has several texts the smallest is taken; equal texts of a class count once, and near copies too. Rows with a
    NULL id, label or text teach nothing; an id labelled both ways counts for both.
    """
    marks = bare(labels, label_id=id_col, label=label_col).where("label in (0, 1) and label_id is not null")
    marks = marks.where(in_training(F.col("label_id"))).distinct()
    totals = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    texts = bare(docs, doc_id=id_col, text=text_col).where("text is not null")
    taken = []
    for k, label in enumerate((1, 0)):  # class 0 is toxic
        chosen = marks.where(F.col("label") == label).orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)
        found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
        taken.append(found.groupBy(F.sha2("text", 256).alias("key")).agg(F.any_value("text").alias("text")).select(F.lit(k).alias("class"), "key", "text"))
    sample = settle_text(taken[0].union(taken[1]), "sample")
    sketches = sorted(tuple(r) for r in _per_row(sample, ["class", "key", "sketch"], [pa.int32(), pa.string(), pa.list_(pa.int64())],
                                                 lambda k, key, text: [(k, key, sketch(text))]).collect())
    kept = []
    for k in (0, 1):
        own = [(key, least) for at, key, least in sketches if at == k]
        kept += [(k, own[n][0]) for n in without_copies(least for _, least in own)]
    chosen = docs.sparkSession.createDataFrame(kept, "class int, key string")
    sample = settle_text(sample.join(F.broadcast(chosen), ["class", "key"]), "sample")  # at most two samples' keys
    ratio = totals.get(1, 0) / totals[0] if totals.get(0) and totals.get(1) else None

    def features_of(models):
        found = _per_row(sample, ["class", "key", "features"], [pa.int32(), pa.string(), pa.list_(pa.float64())],
                         lambda k, key, text: [(k, key, models[_fold(text)].features(text))]).collect()
        return [(k, x) for k, _, x in sorted(tuple(r) for r in found)]

    return _trained(*_sample_counts(sample), features_of, ratio)


def score(docs, model, id_col="doc_id", text_col="text"):
    """``doc_id, held_out, score, predicted`` of every whole text.

    ``held_out`` marks ids whose labels are never learnt from. NULL, empty and blank texts score as texts without any
    window. A NULL id is not held out. Repeated rows stay; extra columns are left out; an empty table gives an empty table.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, model.score(t)) for i, t in rows_of(batch, "doc_id", "text")), schema)

    scored = bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_ordinary(docs, model, text_col="text"):
    """The rows of ``docs`` that are not predicted toxic, all columns as they were.

    NULL, empty and blank texts are scored as texts without any window; repeated rows share their verdict; an empty table stays empty.
    """
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([model.score(texts[i].as_py()) < 0.5 for i in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
