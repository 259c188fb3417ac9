"""Toxic texts by a support vector machine on a subsequence string kernel with Nystroem landmarks.

The kernel of two strings sums over the subsequences of three characters that both hold, each weighted by DECAY to the power of the
stretch it covers in either, so `idiot`, `idxiot` and `id-iot` stay close. Landmarks are strings that stand out in labelled toxic
training texts. A text is described by its words' normalised kernel values with each landmark, pooled over the text (the largest
value, and how often values are high), and mapped by the landmarks' own kernel matrix to the power -1/2. A linear machine is
trained on these descriptions of a bounded sample of labelled texts; its margins become scores by logistic calibration.

Words are lower-cased and stripped of all but letters and digits, so characters inserted from outside fall away; runs of single
characters count as one word. A word that lacks over two fifths of a landmark's neighbouring letters, with up to two characters between
them in the word, counts as unlike it; a hashed table of such pairs in each word finds those worth a kernel. Words of more than LONGEST
letters, as in scripts without blanks, are taken in short windows, each a word of its own: all of SHORT letters, and wider ones for
insults with gaps. So a word's cost grows with its length only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.llm.words import distinct_spans, find_words, slices, text_bytes, tidy

ORDER = 3
DECAY = 0.7
LANDMARKS = 96
#: Labelled texts of either class that are used at most, those with the smallest hash of their id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2500, 5000
#: Strings that a task counts before it sends them.
COUNTED = 20_000
#: Toxic texts that hold a string that is to tell them from clean ones.
LEAST_TOXIC = 2
#: Strings that come to the driver to choose landmarks from.
CANDIDATES = 1500
HELD_OUT = 5
PREFIXES = (4, 5, 6, 7, 8)
LIKE = 0.5
#: Letters of a word that are compared at once; letters of the windows of longer words, and how far apart the wide ones start.
LONGEST, SHORT, WIDE, WIDE_STEP = 48, 6, 12, 4
#: Characters in between that a landmark's neighbours may have in a word, and one more.
REACH = 3
PAIR_BITS = 256
#: What is worked on at once: bytes of text, characters of words, strings in a kernel.
SLICE, GROUP_CHARACTERS, KERNEL_ROWS = 2 << 20, 1_000_000, 20_000


def encode(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, padded by zeros, and lengths."""
    size = np.array([len(s) for s in strings], np.int64)
    out = np.zeros((len(strings), int(size.max()) if len(strings) else 0), np.uint32)
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: the gap-weighted subsequence kernel of the strings in a and b (padded code points). Dynamic programming over the
    characters of a; `tail` is the weight of common subsequences whose last character is followed by gaps up to the current place."""
    n, width = b.shape
    # A row for each place in b, so that steps along it are steps through memory.
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    # count[i][j]: subsequences of i characters in a so far and the first j characters of b, weighted to the current ends of both.
    count = [np.ones((width + 1, n), np.float32)] + [np.zeros((width + 1, n), np.float32) for _ in range(ORDER - 1)]
    total, tail = np.zeros(n, np.float32), np.empty(n, np.float32)
    decay, both = np.float32(DECAY), np.float32(DECAY**2)
    for character in a:
        same = (character == b) & (b != 0)
        total += (count[ORDER - 1][:width] * same).sum(axis=0)
        for i in range(ORDER - 1, 0, -1):
            step = count[i - 1][:width] * same
            step *= both
            count[i] *= decay
            tail[:] = 0
            for j in range(width):
                tail *= decay
                tail += step[j]
                count[i][j + 1] += tail
    return total.astype(np.float64) * DECAY**2


def own_kernel(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The kernel of each string with itself, by groups of similar length."""
    out = np.zeros(len(codes))
    band = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
    for g in np.unique(band):
        of = np.flatnonzero(band == g)
        x = codes[of, : int(size[of].max())]
        out[of] = kernel(x, x)
    return out


def plain(word: str) -> str:
    word = word.lower()
    return word if word.isalnum() else "".join(c for c in word if c.isalnum())


def windows(word: str) -> list[str]:
    """The word, or its windows if it is longer than LONGEST."""
    if len(word) <= LONGEST:
        return [word]
    starts = [(i, SHORT) for i in range(len(word) - SHORT + 1)] + [(i, WIDE) for i in range(0, len(word) - SHORT, WIDE_STEP)]
    return [word[i : i + n] for i, n in starts]


def pair_bits(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The place of each pair of code points in a table of PAIR_BITS bits."""
    return ((first.astype(np.uint32) * np.uint32(0x9E3779B1) + second) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - PAIR_BITS.bit_length() + 1)


def pair_table(codes: np.ndarray) -> np.ndarray:
    """For each string the pairs of characters at most REACH apart, as PAIR_BITS / 64 numbers of 64 bits."""
    out = np.zeros((len(codes), PAIR_BITS // 64), np.uint64)
    for gap in range(1, min(REACH, codes.shape[1] - 1) + 1):
        first, second = codes[:, :-gap], codes[:, gap:]
        place = pair_bits(first, second)
        bit = np.where((first > 0) & (second > 0), np.uint64(1) << (place & np.uint32(63)).astype(np.uint64), np.uint64(0))
        for k in range(out.shape[1]):
            out[:, k] |= np.bitwise_or.reduce(np.where(place >> np.uint32(6) == k, bit, np.uint64(0)), axis=1)
    return out


@dataclass
class Landmarks:
    """Marked strings: `^` stands at the front of every string, `$` at the end of whole words."""

    strings: list[str]

    def __post_init__(self):
        self.codes, self.size = encode(self.strings)
        self.own = own_kernel(self.codes, self.size)
        self.pairs = [pair_bits(c[: n - 1], c[1:n]).astype(np.int64) for c, n in zip(self.codes, self.size)]

    def similar(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, landmark and normalised kernel value of all that are alike."""
        rows, marks, values = [], [], []
        for part in by_length(words):
            row, mark, value = self._similar([words[i] for i in part])
            rows.append(part[row])
            marks.append(mark)
            values.append(value)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(rows), np.concatenate(marks), np.concatenate(values)

    def _similar(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, size = encode(["^" + w + "$" for w in words])
        held = pair_table(codes)
        rows, marks = [], []
        for m in range(len(self.strings)):
            shared = np.zeros(len(words), np.int64)
            for place in self.pairs[m]:
                shared += ((held[:, place >> 6] >> np.uint64(place & 63)) & np.uint64(1)).astype(np.int64)
            near = np.flatnonzero(5 * shared >= 3 * len(self.pairs[m]))
            rows.append(near)
            marks.append(np.full(len(near), m))
        row, mark = np.concatenate(rows), np.concatenate(marks)
        own, known = np.zeros(len(words)), np.unique(row)
        for part in np.array_split(known, len(known) // KERNEL_ROWS + 1):
            own[part] = own_kernel(codes[part], size[part])
        value = np.zeros(len(row))
        # Landmarks of one length are compared together.
        for n in np.unique(self.size[mark]):
            of = np.flatnonzero(self.size[mark] == n)
            for part in np.array_split(of, len(of) // KERNEL_ROWS + 1):
                value[part] = kernel(codes[row[part]], self.codes[mark[part], :n])
        value /= np.sqrt(np.maximum(own[row] * self.own[mark], 1e-300))
        alike = value >= LIKE
        return row[alike], mark[alike], value[alike]

    def matrix(self) -> np.ndarray:
        n = len(self.strings)
        out = np.zeros((n, n))
        for m in range(n):
            mark = np.broadcast_to(self.codes[m, : self.size[m]], (n, int(self.size[m])))
            out[m] = kernel(self.codes, mark) / np.sqrt(self.own * self.own[m])
        return out


def by_length(words: list[str]) -> list[np.ndarray]:
    """Numbers of the words, in groups of like length that are worked on together."""
    size = np.array([len(w) for w in words], np.int64)
    band = np.searchsorted([10, 16, 32, 64, 256, 1024, 4096], size)
    out = []
    for g in np.unique(band):
        of = np.flatnonzero(band == g)
        out += np.array_split(of, len(of) * int(size[of].max() + 2) // GROUP_CHARACTERS + 1)
    return out


def plain_words(rows: pa.RecordBatch, text: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct plain words of a slice, and for each word of the texts its document and its number among the distinct ones; the number
    of words of each document. Runs of single-character words are joined, and long words come as their windows."""
    found = find_words(*text_bytes(rows.column(text)))
    at, which = distinct_spans(found.data, found.start, found.end)
    raw = found.data.tobytes()
    words = [plain(raw[a:b].decode("utf-8", "replace")) for a, b in zip(found.start[at].tolist(), found.end[at].tolist())]
    doc = found.doc
    single = np.array([len(w) == 1 for w in words], bool)[which] if len(which) else np.zeros(0, bool)
    # A run of three or more single characters in one document.
    edge = np.append(True, (doc[1:] != doc[:-1]) | ~single[:-1] | ~single[1:]) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(doc)))
    runs = [(int(a), int(a + n)) for a, n in zip(first[size >= 3], size[size >= 3])]
    extra = ["".join(words[i] for i in which[a:b]) for a, b in runs]
    doc = np.concatenate([doc, doc[[a for a, _ in runs]]]) if runs else doc
    which = np.concatenate([which, len(words) + np.arange(len(runs))]) if runs else which
    words += extra
    if any(len(w) > LONGEST for w in words):
        known: dict[str, int] = {}
        parts = [[known.setdefault(x, len(known)) for x in windows(w)] for w in words]
        each = np.array([len(p) for p in parts])
        start, repeat = np.cumsum(each) - each, each[which]
        place = np.repeat(start[which], repeat) + np.arange(int(repeat.sum())) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        doc, which, words = np.repeat(doc, repeat), np.array([x for p in parts for x in p])[place], list(known)
    return words, doc, which, found.counts


def strings_of(words: set[str]) -> set[str]:
    """Strings that may become landmarks: whole words and fronts of words."""
    return {f"^{w}$" for w in words if 1 <= len(w) <= 20} | {f"^{w[:n]}" for w in words for n in PREFIXES if len(w) > n}


def describe(rows: pa.RecordBatch, text: int, landmarks: Landmarks) -> np.ndarray:
    """For each text the largest value with each landmark, then the logarithm of how often values are high, in parts of all words."""
    words, doc, which, counts = plain_words(rows, text)
    m = len(landmarks.strings)
    top, often = np.zeros((rows.num_rows, m)), np.zeros((rows.num_rows, m))
    word, mark, value = landmarks.similar(words)
    order = np.argsort(word, kind="stable")
    mark, value = mark[order], value[order]
    each = np.bincount(word, minlength=len(words))
    first = np.cumsum(each) - each
    hit = np.flatnonzero(each[which] > 0) if len(which) else np.zeros(0, np.int64)
    if len(hit):
        n = each[which[hit]]
        stop = np.cumsum(n)
        take = np.repeat(first[which[hit]] - stop + n, n) + np.arange(int(stop[-1]))
        d = np.repeat(doc[hit], n)
        np.maximum.at(top, (d, mark[take]), value[take])
        np.add.at(often, (d, mark[take]), value[take] ** 4)
    return np.hstack([top, np.log1p(200 * often / np.maximum(counts, 1)[:, None])])


# ---- training --------------------------------------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(HELD_OUT)) == 0


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of the training sample: labelled rows that are not held out, a bounded number of either class. The ids are chosen
    from the labels alone and broadcast."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.filter("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).union(usable.filter("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts hold each whole word and each front of a word; what a task has counted so far is sent whenever it
    holds many strings, so a string may come several times."""
    counts = (Counter(), Counter())
    texts = [0, 0]

    def sent() -> pa.RecordBatch:
        strings = list(counts[1] | counts[0])
        rows = [*strings, ""], [*(counts[1][s] for s in strings), texts[1]], [*(counts[0][s] for s in strings), texts[0]]
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64())], ["string", "n_toxic", "n_clean"])

    for batch in batches:
        for rows in slices(batch, 0):
            words, doc, which, _ = plain_words(rows, 0)
            toxic = rows.column(1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(np.sort(doc), np.arange(rows.num_rows + 1))
            order = np.argsort(doc, kind="stable")
            for d in range(rows.num_rows):
                own = {words[i] for i in set(which[order[at[d] : at[d + 1]]].tolist())}
                counts[int(toxic[d])].update(strings_of(own))
                texts[int(toxic[d])] += 1
                if len(counts[0]) + len(counts[1]) >= COUNTED:
                    yield sent()
                    counts, texts = (Counter(), Counter()), [0, 0]
    yield sent()


def choose_landmarks(rows: list[tuple[str, int, int]], texts: tuple[int, int], most: int = LANDMARKS) -> list[str]:
    """The strings that tell toxic from clean texts best, by expected surprise, none nearly equal to another."""
    toxic, clean = texts
    scored = []
    for s, p, n in rows:
        rate_p, rate_n = (p + 0.5) / (toxic + 1), (n + 0.5) / (clean + 1)
        if rate_p > 3 * rate_n:
            scored.append((p * np.log(rate_p / rate_n), s))
    scored.sort(key=lambda x: (-x[0], x[1]))
    chosen: list[str] = []
    for _, s in scored:
        if len(chosen) == most:
            break
        # A front of a chosen string, or one that goes on from it, tells the same.
        if sum(s.rstrip("$").startswith(c.rstrip("$")) or c.rstrip("$").startswith(s.rstrip("$")) for c in chosen) < 3:
            chosen.append(s)
    return chosen


def train_machine(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss and classes of equal weight, by accelerated gradient descent."""
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    design = np.hstack([x, np.ones((len(x), 1))])
    step = 1.0 / (1 + 2 * cost * np.linalg.norm(design * np.sqrt(weight)[:, None], 2) ** 2 / len(y))
    w = look = np.zeros(design.shape[1])
    for t in range(rounds):
        short = np.maximum(0, 1 - sign * (design @ look))
        grad = 1e-3 * np.append(look[:-1], 0) - 2 * cost * design.T @ (weight * sign * short) / len(y)
        new = look - step * grad
        w, look = new, new + t / (t + 3) * (new - w)
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels, with targets drawn in a little, by Newton's method."""
    p, n = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (p + 1) / (p + 2), 1 / (n + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        gap, curve = q - target, np.maximum(q * (1 - q), 1e-9)
        g = np.array([(gap * margin).sum(), gap.sum()])
        h = np.array([[(curve * margin**2).sum() + 1e-6, (curve * margin).sum()], [(curve * margin).sum(), curve.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - move[0], b - move[1]
        if abs(move).max() < 1e-9:
            break
    return float(max(a, 1e-6)), float(b)


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def scores(self, described: np.ndarray) -> np.ndarray:
        margin = described @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def _describer(landmarks: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Landmarks(landmarks)
        for batch in batches:
            for rows in slices(batch, 0, SLICE):
                described = describe(rows, 0, marks)
                yield pa.RecordBatch.from_arrays([rows.column(1), pa.array(list(described), pa.list_(pa.float64()))], ["toxic", "described"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the bounded sample; without toxic or without clean training texts the model scores all texts by the share of toxic ones."""
    texts = sample(docs, labels)
    counted = texts.mapInArrow(tidy(_count_strings), "string string, n_toxic bigint, n_clean bigint").groupBy("string").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    total = counted.filter("string = ''").collect()
    toxic, clean = (int(total[0][1]), int(total[0][2])) if total else (0, 0)
    if not toxic or not clean:
        share = (toxic + 0.01) / (toxic + clean + 1)
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    telling = F.col("n_toxic") * F.log(((F.col("n_toxic") + 0.5) / (toxic + 1)) / ((F.col("n_clean") + 0.5) / (clean + 1)))
    rows = counted.filter(f"string <> '' AND n_toxic >= {LEAST_TOXIC}").orderBy(telling.desc(), "string").limit(CANDIDATES).collect()
    landmarks = choose_landmarks([tuple(r) for r in rows], (toxic, clean))
    if not landmarks:
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log(toxic / clean)))
    described = texts.mapInArrow(tidy(_describer(landmarks)), "toxic int, described array<double>").collect()
    x, y = np.array([r[1] for r in described]), np.array([r[0] for r in described])
    # Nystroem: both halves of the description are mapped by the landmarks' matrix to the power -1/2.
    value, vector = np.linalg.eigh(Landmarks(landmarks).matrix())
    half = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T
    n = len(landmarks)
    mapped = np.hstack([x[:, :n] @ half, x[:, n:] @ half])
    weights, offset = train_machine(mapped, y)
    slope, shift = calibrate(mapped @ weights + offset, y)
    return Model(landmarks, np.concatenate([half @ weights[:n], half @ weights[n:]]), offset, slope, shift)


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Landmarks(model.landmarks) if model.landmarks else None
        for batch in batches:
            for rows in slices(batch, 0, SLICE):
                described = describe(rows, 0, marks) if marks else np.zeros((rows.num_rows, 0))
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(model.scores(described))], [*rows.schema.names[1:], "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs without text, plus score (0 to 1). Scores depend on the text alone; null or empty text gets the score of no likeness.
    Repeated rows are scored each for itself; a column named score is replaced. An empty table gives an empty table."""
    kept = [f for f in docs.schema if f.name not in ("text", "score")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "score double"
    return docs.select(F.col("text").cast("string").alias("text"), *[f"`{f.name}`" for f in kept]).mapInArrow(tidy(_scorer(model)), schema)


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs without the rows that score `threshold` or more; the columns stay the same. Rows without text score like any text without
    likeness, repeated rows alike; an empty table stays empty."""
    copy = docs.withColumn("__llm_kept_text", F.col("text"))
    scored = score(copy.withColumnRenamed("score", "__llm_score") if "score" in docs.columns else copy, model)
    scored = scored.filter(F.col("score") < threshold).drop("score").withColumnRenamed("__llm_kept_text", "text").withColumnRenamed("__llm_score", "score")
    return scored.select(*docs.columns)
