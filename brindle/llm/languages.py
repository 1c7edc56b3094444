"""Language ID: averaged hashed subword embeddings, a linear softmax, and calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import checkpoint, small

#: Buckets of subwords, their sizes in bytes, width of an embedding.
BUCKETS, SIZES, WIDTH = 1 << 13, (2, 3, 4), 16
#: The bounded training sample: rows of a language, rows in all, and numbers in all (buckets and their shares); each language has
#: an equal part of the latter two, and at least one row.
ROWS_OF_LANGUAGE, SAMPLE_ROWS, SAMPLE_NUMBERS = 1000, 256_000, 1 << 24
#: Scores (rows times languages) of the rows that calibrate, at most.
CALIBRATION_SCORES = 1 << 24
CHUNK = 1 << 20
#: Everything but letters of ASCII and bytes of other characters separates words.
_SEPARATE = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))


def subword_counts(text: str) -> np.ndarray:
    """How often the text has subwords of each bucket: runs of 2 to 4 bytes of its lower-cased words, with one space
    as the edge of a word. Long texts are counted piece by piece."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_SEPARATE) + b" "
    out = np.zeros(BUCKETS)
    for at in range(0, len(raw), CHUNK):
        b = np.frombuffer(raw, dtype=np.uint8, count=min(CHUNK + max(SIZES) - 1, len(raw) - at), offset=at)
        space = b == 32
        x = b.astype(np.uint32)
        for n in SIZES:
            m = min(len(b) - n + 1, CHUNK)
            if m <= 0:
                continue
            h = np.full(m, n, dtype=np.uint32)
            inner = np.zeros(m, dtype=bool)
            for j in range(n):
                h = h * np.uint32(0x01000193) + x[j : j + m]
                if 0 < j < n - 1:
                    inner |= space[j : j + m]
            inner |= space[:m] & space[n - 1 : n - 1 + m]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
            out += np.bincount(h[~inner] >> np.uint32(32 - 13), minlength=BUCKETS)
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    """languages, logits of a subword of each bucket (embedding times softmax weights), bias, temperature, threshold."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, threshold: float = 0.0):
        self.languages, self.table, self.bias, self.temperature, self.threshold = languages, table, bias, temperature, threshold

    def logits(self, counts: np.ndarray) -> np.ndarray:
        """The average of embeddings times the weights is the average of their products."""
        return counts @ self.table / max(counts.sum(), 1.0) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0, False
        z = self.logits(subword_counts(text)) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] >= self.threshold)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 12, least_steps: int = 20_000, rate: float = 4.0, seed: int = 7) -> Model:
    """Stochastic gradient descent over (language, buckets, shares of the text); a fifth is kept to calibrate, or fewer rows where
    these would have more than `CALIBRATION_SCORES` scores. The model has 64 KB a language.

    The temperature minimises the calibration rows' negative log likelihood; the threshold is the least score above
    which 99 % of them are right, so that `accepted` means what it says.
    """
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    at = {x: i for i, x in enumerate(languages)}
    rows = [rows[i] for i in rng.permutation(len(rows))]
    cut = min(len(rows) // 5, max(20, CALIBRATION_SCORES // len(languages))) if len(rows) >= 20 else 0
    tuning, fitting = rows[:cut], rows[cut:]
    epochs = max(epochs, -(-least_steps // len(fitting)))
    emb = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    out, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    steps, done = epochs * len(fitting), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fitting)):
            language, buckets, share = fitting[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ emb[buckets]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[at[language]] -= 1
            back = out @ p
            out -= 0.1 * step * np.outer(mean, p)
            bias -= 0.01 * step * p
            emb[buckets] -= step * np.outer(share, back)
    model = Model(languages, emb @ out, bias)
    checked = tuning or fitting
    z = np.array([share @ model.table[buckets] + bias for _, buckets, share in checked])
    y = np.array([at[r[0]] for r in checked])

    def scores(t: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.05, 20, 60)
    model.temperature = float(grid[np.argmin([-np.log(np.maximum(scores(t)[np.arange(len(y)), y], 1e-300)).mean() for t in grid])])
    p = scores(model.temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    good = np.cumsum(right[order]) >= 0.99 * np.arange(1, len(y) + 1)
    model.threshold = float(top[order][np.flatnonzero(good).max()]) if good.any() else 1.0
    return model


def training_sample(docs: DataFrame, text_col: str, label_col: str, rows_of_language: int = ROWS_OF_LANGUAGE) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """`rows_of_language` rows of each language (fewer where it has fewer), as subword shares of their whole texts.

    The rows are those of the smallest hashes of id and text among the language's distinct rows, so copies of a text under
    other ids count and reruns agree. At most `SAMPLE_ROWS` rows with `SAMPLE_NUMBERS` numbers come to the driver (and a row of each language
    in any case): where there are many languages or very long texts each language gets fewer rows, but none gets none.
    """
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(label_col).alias("label"), F.col(text_col).alias("text"), F.xxhash64("id", text_col).alias("h"))
    counts = checkpoint(labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.col("label").alias("known"), "n"))
    languages = counts.count()
    if not languages:
        return []
    each = max(1, min(rows_of_language, SAMPLE_ROWS // languages))
    scale = 1 << 30
    # half as many again as are wanted, and some, so that the exact choice is made among few
    share = F.least(F.lit(1.0), (1.5 * each + 50) / F.col("n")) * scale
    near = labelled.join(small(counts), F.col("label") == F.col("known")).where(F.pmod("h", F.lit(scale)) < share).dropDuplicates(["label", "h"])
    by = Window.partitionBy("label").orderBy(F.pmod("h", F.lit(scale)), "h")
    chosen = near.withColumn("k", F.row_number().over(by)).where(F.col("k") <= each).select("label", "text", "k")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, places, buckets, shares = [], [], [], []
            for label, text, k in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(text):
                    c = subword_counts(text)
                    b = np.flatnonzero(c)
                    labels.append(label), places.append(k), buckets.append(b.astype(np.int16).tobytes()), shares.append((c[b] / c.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(places, pa.int32()), pa.array(buckets, pa.binary()), pa.array(shares, pa.binary())], names=["label", "k", "buckets", "shares"])

    counted = chosen.mapInArrow(features, "label string, k int, buckets binary, shares binary")
    before = F.coalesce(F.sum(F.octet_length("shares") / 4).over(Window.partitionBy("label").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.row_number().over(Window.partitionBy("label").orderBy("k")) == 1
    fit = counted.withColumns({"first": first, "before": before}).where(F.col("first") | (F.col("before") + F.octet_length("shares") / 4 <= SAMPLE_NUMBERS // languages))
    rows = fit.select("label", "buckets", "shares").collect()
    rows = sorted((r[0], bytes(r[1]), bytes(r[2])) for r in rows)
    return [(x, np.frombuffer(b, np.int16).astype(np.int64), np.frombuffer(s, np.float32).astype(float)) for x, b, s in rows if len(b)]


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", held_out: F.Column | None = None, rows_of_language: int = ROWS_OF_LANGUAGE) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (calibrated probability), accepted.

    Only texts and labels of rows that aren't held out are learned from (by default held out where crc32 of the id
    modulo 4 is 2; a null id counts as the empty string), and only the text is used to predict. Null, empty
    and letterless texts are `und` with score 0, as are all rows when nothing is labelled. accepted is false where
    the score is below the calibrated threshold: the prediction is then the best guess only. Rows are judged one
    by one, so repeated rows agree; an empty table gives no rows; other columns are ignored.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
    held_out = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    model = train(training_sample(rows.where("not held_out"), "text", "label", rows_of_language))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.predict(t.as_py()) for t in batch.column(2)]
            columns = [pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["id", "held_out", "lang_pred", "score", "accepted"])

    kind = dict(docs.dtypes)[id_col]
    return rows.select("id", "held_out", "text").mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double, accepted boolean").withColumnRenamed("id", id_col)
