"""Language identification with interpolated Kneser-Ney character models.

A text is read as lower-case letters with every run of other characters as one blank.
For each language a 4-gram model is estimated from counts of a bounded sample of
labelled texts. The models of ``GROUP`` languages share sorted arrays of 64-bit gram
hashes, with a row of log probabilities, one per language, for each hash, so that memory
grows with the number of languages and not with its square. The language with the
lowest cross-entropy per symbol wins; a second sample, not used for counting,
calibrates the score and the rejection of texts that no model explains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.common import blocks, mix

ORDER = 4
#: Labelled texts of each language that are counted, and that calibrate: expected sizes
#: of samples drawn by a hash of the id.
COUNTED, CALIBRATING = 2000, 400
#: Languages whose models share arrays, which have a column for each of them.
GROUP = 32
#: Symbols scored at once, which bounds the memory for texts of any length.
CHUNK = 1 << 18


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Lower-case code of each letter below U+10000, 0 for other characters."""
    found = np.zeros(0x10000, np.uint16)
    for code in range(0x10000):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            found[code] = ord(low) if len(low) == 1 else code
    return found


def _high_symbol(code: int) -> int:
    """Symbol of a character above U+FFFF: 0, or for letters one of the codes of surrogates
    and private use, which are no letters. Letters of one script stay apart."""
    letter = chr(code)
    if not letter.isalpha():
        return 0
    low = letter.lower()
    return 0xD800 + (ord(low) if len(low) == 1 else code) % 0x2100


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts end to end (0: a blank), and where each text begins.

    A text ends with a blank unless it has no letter; then it has no symbols.
    """
    texts = pc.fill_null(texts, "")
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    joined = "\n".join(texts.to_pylist()) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    found = _symbols()[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        distinct, which = np.unique(codes[high], return_inverse=True)
        found[high] = np.array([_high_symbol(c) for c in distinct.tolist()], np.uint16)[which]
    begins = np.concatenate(([0], np.cumsum(sizes)))
    kept = found != 0
    kept[1:] |= kept[:-1]
    # Nothing of one text follows another: its first blank has no letter before it.
    first = begins[:-1]
    kept[first] = found[first] != 0
    total = np.concatenate(([0], np.cumsum(kept)))
    return found[kept], total[begins]


def grams(stream: np.ndarray, begins: np.ndarray, first: int, last: int) -> np.ndarray:
    """Packed 4-grams that end at the symbols first ... last - 1; before a text stand blanks."""
    low = max(0, first - ORDER + 1)
    part = stream[low:last].astype(np.uint64)
    out = part[first - low :].copy()
    inside = begins[(begins > low - ORDER) & (begins < last)]
    for back in range(1, ORDER):
        earlier = np.zeros(last - first, np.uint64)
        skip = max(0, back - (first - low))
        earlier[skip:] = part[first - low + skip - back : last - low - back]
        for step in range(back):
            at = inside + step - first
            earlier[at[(at >= 0) & (at < last - first)]] = 0
        out |= earlier << np.uint64(16 * back)
    return out


@dataclass
class Level:
    """Grams of one length: hashes with log2 probabilities, and the weight that each
    history leaves to the level below, both with a column per language."""

    grams: np.ndarray
    logs: np.ndarray
    histories: np.ndarray
    left: np.ndarray


@dataclass
class Group:
    """The models of some languages."""

    size: int
    levels: list[Level]  # of length 1 ... ORDER
    floor: float  # log2 probability of a symbol that was never seen

    def level(self, packed: np.ndarray, length: int) -> np.ndarray:
        if length == 0:
            return np.full((len(packed), self.size), self.floor, np.float32)
        level = self.levels[length - 1]
        own = packed if length == ORDER else packed & np.uint64((1 << 16 * length) - 1)
        at, known = _find(level.grams, mix(own, length))
        out = level.logs[at]
        missing = np.flatnonzero(~known)
        if len(missing):
            history = own[missing] >> np.uint64(16)
            place, seen = _find(level.histories, mix(history, length + 64))
            out[missing] = np.where(seen[:, None], level.left[place], 0) + self.level(
                packed[missing], length - 1
            )
        return out


@dataclass
class Model:
    languages: list[str]
    groups: list[Group]  # of languages in their order
    alphabet: np.ndarray
    sharpness: float = 1.0
    limit: float = np.inf
    slack: float = 0.0

    def log_probabilities(self, packed: np.ndarray) -> np.ndarray:
        return np.concatenate([group.level(packed, ORDER) for group in self.groups], axis=1)


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(table, wanted)
    at[at == len(table)] = 0
    return at, table[at] == wanted


def estimate(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models from each language's 4-grams (packed) and their counts.

    The longest grams use counts, shorter ones the number of different symbols seen
    before them; each level gives up a discount of its own per gram to the level below.
    """
    languages = sorted(counts)
    alphabet = np.unique(np.concatenate([np.unique(g & np.uint64(0xFFFF)) for g, _ in counts.values()]))
    floor = -float(np.log2(len(alphabet) + 1))
    parts = [languages[a : a + GROUP] for a in range(0, len(languages), GROUP)]
    groups = [_estimated({x: counts[x] for x in part}, floor) for part in parts]
    return Model(languages, groups, alphabet)


def _estimated(counts: dict[str, tuple[np.ndarray, np.ndarray]], floor: float) -> Group:
    languages = list(counts)
    seen = dict(counts)
    tables: list[list[tuple]] = []
    for length in range(ORDER, 0, -1):
        row = []
        for name in languages:
            gram, n = seen[name]
            history, start = np.unique(gram >> np.uint64(16), return_index=True)
            total = np.add.reduceat(n, start).astype(float)
            kinds = np.diff(np.append(start, len(gram)))
            once, twice = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
            discount = once / (once + 2 * twice) if once else 0.5
            row.append((gram, n, history, total, kinds, discount))
        tables.insert(0, row)
        # Different first symbols of each gram that is one shorter.
        for name in languages:
            shorter = seen[name][0] & np.uint64((1 << 16 * (length - 1)) - 1)
            seen[name] = tuple(np.unique(shorter, return_counts=True))
    group = Group(len(languages), [], floor)
    for length, row in enumerate(tables, 1):
        every = np.unique(np.concatenate([x[0] for x in row]))
        past = np.unique(np.concatenate([x[2] for x in row]))
        below = np.exp2(group.level(every, length - 1).astype(float))
        chance, left = np.zeros((len(every), len(row))), np.zeros((len(past), len(row)))
        for k, (gram, n, history, total, kinds, discount) in enumerate(row):
            left[np.searchsorted(past, history), k] = discount * kinds / total
            left[~np.isin(past, history), k] = 1
            own = np.searchsorted(history, gram >> np.uint64(16))
            chance[np.searchsorted(every, gram), k] = np.maximum(n - discount, 0) / total[own]
            chance[:, k] += left[np.searchsorted(past, every >> np.uint64(16)), k] * below[:, k]
        by_hash = np.argsort(mix(every, length))
        by_past = np.argsort(mix(past, length + 64))
        group.levels.append(
            Level(
                mix(every, length)[by_hash],
                np.log2(chance[by_hash]).astype(np.float32),
                mix(past, length + 64)[by_past],
                np.log2(left[by_past]).astype(np.float32),
            )
        )
    return group


def cross_entropies(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits per symbol of each text under each language, and the texts' symbol counts."""
    stream, begins = symbols(texts)
    sums = np.zeros((len(texts), len(model.languages)))
    for first in range(0, len(stream), CHUNK):
        last = min(first + CHUNK, len(stream))
        logs = model.log_probabilities(grams(stream, begins, first, last))
        text = np.searchsorted(begins, np.arange(first, last), "right") - 1
        low = text[0]
        for k in range(sums.shape[1]):
            part = np.bincount(text - low, logs[:, k])
            sums[low : low + len(part), k] -= part
    n = np.diff(begins)
    return sums / np.maximum(n, 1)[:, None], n


def score(model: Model, entropies: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The calibrated share of the best language among all."""
    weight = model.sharpness * np.sqrt(n)
    gap = (entropies - entropies.min(axis=1, keepdims=True)) * weight[:, None]
    return 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)


def calibrate(model: Model, entropies: np.ndarray, n: np.ndarray, own: np.ndarray) -> None:
    """Set the sharpness of scores and the limit beyond which a text is rejected.

    The sharpness is the one with the least log loss. The limit on the cross-entropy is
    half way from the largest value but one in a thousand that texts have under their own
    language to that of symbols drawn evenly; short texts get an allowance that falls
    with the root of their length.
    """
    best = entropies[np.arange(len(own)), own]
    losses = []
    grid = [2.0**k for k in range(-6, 7)]
    for sharpness in grid:
        gap = np.minimum((entropies - best[:, None]) * (sharpness * np.sqrt(n))[:, None], 1000)
        losses.append(np.log2(np.exp2(-np.maximum(gap, -1000)).sum(axis=1)).mean())
    model.sharpness = grid[int(np.argmin(losses))]
    genuine = float(np.quantile(best, 0.999))
    rng = np.random.default_rng(7)
    noise = rng.choice(model.alphabet, 4000).astype(np.uint16)
    chaos = -model.log_probabilities(grams(noise, np.array([0]), 0, len(noise))).max(axis=1).mean()
    model.limit = genuine + max(1.0, (float(chaos) - genuine) / 2)
    model.slack = 4.0


def _hashed(salt: str, modulus: int) -> Column:
    """A number below the modulus for each row, by its id, or by the text without one."""
    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    return F.pmod(F.xxhash64("doc_id", own, F.lit(salt)), F.lit(modulus))


def _drawn(wanted: int, salt: str) -> Column:
    """Whether a row is among about ``wanted`` texts of its language, which has ``_total``."""
    threshold = F.least(F.lit(1 << 30), F.floor(F.lit(wanted << 30) / F.col("_total")))
    return _hashed(salt, 1 << 30) < threshold


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, limit=1 << 20):
        langs, apart = batch.column("lang"), batch.column("apart")
        for name in pc.unique(langs).to_pylist():
            for held in (False, True):
                mine = pc.and_(pc.equal(langs, name), pc.equal(apart, held))
                stream, begins = symbols(batch.column("text").filter(mine))
                if len(stream):
                    gram, n = np.unique(grams(stream, begins, 0, len(stream)), return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([name] * len(gram)),
                            "gram": gram.view(np.int64),
                            "n": n,
                            "rest": np.zeros_like(n) if held else n,
                        }
                    )


def _counted(texts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each language's 4-grams, ascending, with their counts in all texts and in those not
    ``apart``. Rows are ``lang, text, apart``."""
    counts = (
        texts.mapInArrow(_count, "lang string, gram long, n long, rest long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"))
        .toPandas()
    )
    packed = {}
    for name, rows in counts.groupby("lang"):
        gram = rows["gram"].to_numpy().view(np.uint64)
        order = np.argsort(gram)
        packed[name] = (gram[order], *(rows[c].to_numpy()[order] for c in ("n", "rest")))
    return packed


def train(
    labelled: DataFrame, counted: int = COUNTED, calibrating: int = CALIBRATING
) -> Model | None:
    """A calibrated model from rows ``doc_id, text, lang``; none if no text is labelled.

    Samples of about ``counted`` and ``calibrating`` texts of each language are used,
    whatever the size of the table: those whose ids hash lowest. Languages with ``counted``
    texts at most are counted whole: the second sample then calibrates a model without the
    texts of its own part, and the result counts these too. The second sample is only used
    if it is not empty.
    """
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    spark = labelled.sparkSession
    totals = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not totals:
        return None
    known = spark.createDataFrame(list(totals.items()), "lang string, _total long")
    # One small row per label, which the driver holds anyway.
    labelled = labelled.join(F.broadcast(known), "lang")
    apart = _hashed("part", 6) == 0
    whole = F.col("_total") <= counted
    texts = labelled.where(whole | ~apart & _drawn(counted, "count")).select(
        "lang", "text", apart.alias("apart")
    )
    names = sorted(totals)
    packed = {}
    for first in range(0, len(names), GROUP):
        mine = F.col("lang").isin(names[first : first + GROUP])
        packed |= _counted(texts.where(mine) if len(names) > GROUP else texts)
    # Larger languages of which the hash of the id draws nothing, as ids are repeated.
    for name in [x for x in names if x not in packed and totals[x] > counted]:
        order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
        rows = labelled.where((F.col("lang") == name) & F.rlike("text", F.lit(r"\p{L}"))).withColumn(
            "_rank", F.row_number().over(order)
        )
        packed |= _counted(rows.where(F.col("_rank") <= counted).select("lang", "text", F.lit(True).alias("apart")))
    if not packed:
        return None
    rest = {x: (g[m > 0], m[m > 0]) for x, (g, _, m) in packed.items() if m.any()}
    every = {x: (g, n) for x, (g, n, _) in packed.items()}
    same = all((n == m).all() for _, n, m in packed.values())
    if not rest:
        return estimate(every)
    model = estimate(rest)
    shared = spark.sparkContext.broadcast(model)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=1 << 20):
            bits, n = cross_entropies(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {"lang": batch.column("lang"), "n": n, "bits": pa.array(list(bits), pa.list_(pa.float64()))}
            )

    rows = (
        labelled.where(apart & _drawn(calibrating, "calibrate"))
        .select("lang", "text")
        .mapInArrow(entropies, "lang string, n long, bits array<double>")
        .where(F.col("n") > 0)
        .toPandas()
    )
    own = {name: k for k, name in enumerate(model.languages)}
    rows = rows[rows["lang"].isin(own)]
    if len(rows):
        calibrate(
            model,
            np.stack(rows["bits"].to_numpy()),
            rows["n"].to_numpy(),
            rows["lang"].map(own).to_numpy(),
        )
    if same:
        return model
    shared.unpersist()
    final = estimate(every)
    final.sharpness, final.limit, final.slack = model.sharpness, model.limit, model.slack
    return final


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``lang_pred, score, bits, rejected`` to rows with a ``text``.

    A text that is null or has no letter, and any text without a model, is ``und`` with
    score 0 and rejected. ``bits`` is the cross-entropy under the best language. Other
    columns stay; those with one of the four names are replaced.
    """
    added = ("lang_pred", "score", "bits", "rejected")
    docs = docs.drop(*added)
    if model is None or not model.languages:
        return docs.select(
            "*",
            F.lit("und").alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("bits"),
            F.lit(True).alias("rejected"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labels = pa.array([*model.languages, "und"])
        for batch in blocks(batches, limit=1 << 20):
            entropies, n = cross_entropies(model, batch.column("text"))
            best = entropies.argmin(axis=1)
            bits = entropies[np.arange(len(best)), best]
            known = n > 0
            rejected = ~known | (bits > model.limit + model.slack / np.sqrt(np.maximum(n, 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    labels.take(pa.array(np.where(known, best, len(model.languages)))),
                    pa.array(np.where(known, score(model, entropies, n), 0.0)),
                    pa.array(bits, mask=~known),
                    pa.array(rejected),
                ],
                [*names, *added],
            )

    schema = T.StructType(docs.schema.fields[:])
    for name, kind in zip(added, ("string", "double", "double", "boolean")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row belongs to the fold kept for testing (never true for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
