"""Toxicity by a support vector machine on a string subsequence kernel, approximated with Nystrom landmarks.

The kernel counts the subsequences of ORDER characters that two strings share, gaps included: an occurrence with g
skipped characters counts decay**g, up to MAX_GAP. So an insult with a character put in, doubled or left out still
shares most of its subsequences. Labels are given to documents and so to their sentences, but most sentences of a toxic
document are clean: a sentence is a bag of fragments (words, letters spelled out one by one, and telling pairs of words)
and is as toxic as its worst fragment, a document as its worst sentence. The machine is trained on such bags: in turns,
each bag names the fragment that witnesses for it, and the machine is fitted on the witnesses.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .arrays import PIECE, U, member, pieces, runs
from .common import cut_lineage

ORDER = 4
DECAY = 0.7
MAX_GAP = 2
LONGEST = 24
SENTENCE = re.compile(r"[.!?\n]+")
EDGES = "\"'.,;:!?()[]{}<>*_-~`|/\\"
CACHE = 150_000
#: Odd multiplier of the 64-bit code of a subsequence, whatever its characters.
CODE = U(0x9E3779B97F4A7C15)


def fragments(text: str, heads: frozenset[str] | None = frozenset()) -> set[str]:
    """Lower-case fragments of a text: words without outer punctuation, the same without inner punctuation, runs of at
    least three single characters as one word, and neighbouring words whose first one is in `heads` (None: all
    neighbouring words); long ones as overlapping parts of at most LONGEST characters."""
    tokens = text.lower().split()
    out = set()
    if heads is None or heads:
        plain = [t.strip(EDGES) for t in tokens]
        out.update(f"{a} {b}" for a, b in zip(plain, plain[1:]) if a and b and (heads is None or a in heads))
    for t in set(tokens):
        t = t.strip(EDGES)
        if len(t) > 1:
            out.add(t)
            if not t.isalnum():
                out.add("".join(filter(str.isalnum, t)))
    single = [i for i, t in enumerate(tokens) if len(t) == 1]
    if len(single) > 2:
        at = np.array(single)
        for run in np.split(at, np.flatnonzero(np.diff(at) != 1) + 1):
            if len(run) > 2:
                out.add("".join(tokens[i] for i in run))
    for t in [t for t in out if len(t) > LONGEST]:
        out.remove(t)
        out.update(t[i : i + LONGEST] for i in range(0, len(t) - LONGEST // 2, LONGEST // 2))
    out.discard("")
    return out


def occurrences(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(unit, subsequence code, weight) for each pattern of gaps; units are marked at both ends."""
    c = np.frombuffer("".join(f"^{u}$" for u in units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    owner = np.repeat(np.arange(len(units)), [len(u) + 2 for u in units])
    for span in range(ORDER, ORDER + 1 + MAX_GAP):
        n = len(c) - span + 1
        if n <= 0:
            continue
        ok = np.flatnonzero(owner[:n] == owner[span - 1 :][:n])
        for inner in combinations(range(1, span - 1), ORDER - 2):
            code = c[ok]
            for step in (*inner, span - 1):
                code = code * CODE + c[ok + step]
            yield owner[ok], code, DECAY ** (span - ORDER)


def norms(units: list[str]) -> np.ndarray:
    total = np.zeros(len(units))
    for owner, _, weight in occurrences(units):
        total += np.bincount(owner, minlength=len(units)) * weight**2
    return np.sqrt(np.maximum(total, 1e-12))


def features(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse normalised subsequence counts: (unit, code, value), summed over occurrences, sorted by code."""
    parts = [(o, k, np.full(len(o), w)) for o, k, w in occurrences(units)]
    owner, code, value = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((owner, code))
    owner, code, value = owner[order], code[order], value[order]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    value = np.add.reduceat(value, at)
    return owner[at], code[at], value / norms(units)[owner[at]]


def kernel(units: list[str], landmarks: list[str], block: int = 128) -> np.ndarray:
    """Normalised kernel values of all units with all landmarks, in blocks of units so that temporaries stay small."""
    lo, lc, lv = features(landmarks)
    first = runs(lc)
    codes = lc[first]
    table = np.zeros((len(first), len(landmarks)), np.float32)
    table[np.repeat(np.arange(len(first)), np.diff(np.append(first, len(lc)))), lo] = lv
    out = np.zeros((len(units), len(landmarks)))
    for i in range(0, len(units), block):
        uo, uc, uv = features(units[i : i + block])
        hit = member(uc, codes)
        order = np.argsort(uo[hit], kind="stable")
        uo, uc, uv = uo[hit][order], uc[hit][order], uv[hit][order]
        at = runs(uo)
        if len(at):
            rows = table[np.searchsorted(codes, uc)] * uv[:, None].astype(np.float32)
            out[i + uo[at]] = np.add.reduceat(rows, at, axis=0)
    return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weighted linear support vector machine (squared hinge), by Newton steps on the active set. y is -1 or 1."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w, weight = np.zeros(x1.shape[1]), weight / weight.sum()
    eye = ridge * np.eye(len(w))
    eye[-1, -1] = 1e-9
    for _ in range(rounds):
        a = (y * (x1 @ w) < 1) if w.any() else np.ones(len(y), bool)
        xa = x1[a] * weight[a][:, None]
        new = np.linalg.solve(xa.T @ x1[a] + eye, xa.T @ y[a])
        if np.allclose(new, w, atol=1e-10):
            break
        w = new
    return w[:-1], float(w[-1])


def disguised(unit: str, seed: int) -> list[str]:
    """The unit with a character put in, with one doubled, and spelled out: what a disguise may look like."""
    rng = np.random.default_rng(zlib.crc32(unit.encode()) + seed)
    i, j = (int(x) for x in rng.integers(1, len(unit), 2))
    extra = "xzqkwj"[int(rng.integers(6))]
    return [unit[:i] + "*" + unit[i:], unit[:j] + extra + unit[j:], unit[:i] + unit[i - 1] + unit[i:], "-".join(unit)]


@dataclass
class ToxicityModel:
    """The machine, folded into one weight per subsequence that a landmark has; at most landmarks x 10 patterns x LONGEST."""

    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -1.0
    slope: float = 1.0
    shift: float = 0.0
    landmarks: list[str] = field(default_factory=list)
    heads: frozenset[str] = frozenset()

    def units(self, units: list[str]) -> np.ndarray:
        """Margins of fragments."""
        if not units:
            return np.zeros(0)
        total = np.zeros(len(units))
        if len(self.codes):
            for owner, code, weight in occurrences(units):
                p = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                hit = self.codes[p] == code
                total += weight * np.bincount(owner[hit], weights=self.weights[p[hit]], minlength=len(units))
        return total / norms(units) + self.bias

    def texts(self, texts: list[str | None], known: dict[str, float]) -> np.ndarray:
        """Margin of each text's best fragment; one without fragments has the margin of one that shares nothing."""
        sets = [fragments(t or "", self.heads) for t in texts]
        new = list(set().union(*sets).difference(known)) if sets else []
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(set().union(*sets))
        for i in range(0, len(new), 10_000):
            known.update(zip(new[i : i + 10_000], self.units(new[i : i + 10_000]).tolist()))
        return np.array([max(map(known.__getitem__, s), default=self.bias) for s in sets])

    def witnesses(self, sentences: list[str], known: dict[str, float]) -> list[tuple[float, str]]:
        """(margin, fragment) of each sentence's worst fragment; (bias, "") for one without fragments."""
        self.texts(sentences, known)
        return [max(((known[f], f) for f in fragments(s, self.heads)), default=(self.bias, "")) for s in sentences]

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def _calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift by Newton steps, with smoothed targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, b = np.stack([margin, np.ones(len(margin))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (p - t)) + 1e-6 * b
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def train(docs: DataFrame, labels: DataFrame, per_label: int = 4000, clean_label: int = 8000, landmarks: int = 256, rounds: int = 3, hold_out: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit the machine on labelled sentences of at most `per_label` toxic and `clean_label` other documents.

    Documents whose crc32(id as text) is divisible by `hold_out` are never used (0: all may be). The sample is the ids
    with the smallest hashes; what follows is bounded by it. Sentences inherit their document's label. The first
    witnesses are the fragments that toxic sentences favour beyond chance, and the most frequent and some random
    fragments of clean sentences; landmarks are chosen among both. Then, in each round, every toxic document names the
    worst fragment of its worst sentence (dropped if the machine finds it clean: labels may be wrong) and every clean
    sentence its worst fragment, and the machine is fitted again, on disguised forms of the toxic witnesses too. Of each
    kind of clean witness as many are kept as there may be toxic documents in the sample: one for each of `per_label`.

    Rows with null ids or labels are left out; a document labelled twice counts as toxic if one label says so. Without
    labels of both kinds, or without sentences under them, every score is the share of toxic labels.
    """
    key = F.col(f"`{id_col}`").cast("long")
    known = labels.select(key.alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("doc_id is not null and y is not null")
    if hold_out:
        known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % hold_out != 0)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    share = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("n1")).first()
    n, n1 = share["n"], share["n1"]
    if not n1 or n1 == n:
        p = (n1 + 1) / (n + 2) if n else 0.0
        return ToxicityModel(slope=0.0, shift=float(np.log(max(p, 1e-9) / (1 - p))) if n else -50.0)
    order = F.xxhash64("doc_id", F.lit(2))
    ids = known.where("y = 1").orderBy(order).limit(per_label).unionByName(known.where("y = 0").orderBy(order).limit(clean_label))
    text = docs.select(key.alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sample = cut_lineage(text.join(F.broadcast(ids), "doc_id"))  # bounded: per_label + clean_label ids

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(y, s) for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()) for s in SENTENCE.split(t or "") if s.strip()]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.string())], ["y", "s"])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(y, u) for y, s in zip(b.column("y").to_pylist(), b.column("s").to_pylist()) for u in fragments(s, None)]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int64()), pa.array([u for _, u in rows], pa.string())], ["y", "unit"])

    prior = ToxicityModel(slope=0.0, shift=float(np.log(n1 / (n - n1))))
    # Each sentence counts once, so that copies of a document don't vouch for its rare words.
    labelled = sample.select("y", "text").mapInArrow(sentences, "y long, s string").groupBy("s").agg(F.min("y").alias("y"))
    counts = cut_lineage(labelled.select("y", "s").mapInArrow(units, "y long, unit string").groupBy("unit").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))
    distinct, a1, b1 = counts.agg(F.count(F.lit(1)), F.sum("a"), F.sum("b")).first()
    if not distinct or not a1 or not b1:
        return prior
    share1 = min(max(a1 / (a1 + b1), 1e-6), 1 - 1e-6)
    both, q = F.col("a") + F.col("b"), F.col("a") / (F.col("a") + F.col("b"))
    divergence = q * F.log(q / share1) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share1))).otherwise(0.0)
    rate = q / share1
    # So unlikely by chance that less than one of all fragments would be.
    telling = counts.where(q > share1).where(both * divergence > float(np.log(distinct) + 2)).where(q > 0.8)
    told = {r["unit"]: r["a"] for r in telling.where(F.length("unit") > 2).orderBy(F.desc("a"), "unit").collect()}
    # A pair says nothing new if one of its words tells as much.
    first = {u: c for u, c in told.items() if " " not in u or not any(w in told for w in u.split())}
    clean = counts.where(F.col("b") > 0).where(rate < 1.5).where(~F.contains("unit", F.lit(" ")))
    negative = {r["unit"]: r["b"] for r in clean.orderBy(F.desc("b"), "unit").limit(per_label).collect()}
    negative |= {r["unit"]: r["b"] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(per_label).collect()}
    if not first or not negative:
        return prior
    marks = list(first)[: 3 * landmarks // 4]
    marks += list(negative)[: landmarks // 8] + list(negative)[-(landmarks // 8) :]
    marks = list(dict.fromkeys(marks))
    heads = frozenset(u.split()[0] for u in first if " " in u)
    gram = kernel(marks, marks)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > 1e-6 * values[-1]
    whiten = vectors[:, keep] / np.sqrt(values[keep])  # features of x: k(x, landmarks) @ whiten
    lo, lc, lv = features(marks)
    at = runs(lc)

    def fit(positive: dict[str, float]) -> ToxicityModel:
        xs, ys, ws = [], [], []
        for u, c in positive.items():
            for v in (u, *(disguised(u, 1) if len(u) > 3 else ())):
                xs.append(v), ys.append(1.0), ws.append(np.sqrt(c))
        for u, c in negative.items():
            xs.append(u), ys.append(-1.0), ws.append(np.sqrt(c))
        y, w = np.array(ys), np.array(ws)
        w = np.where(y > 0, w / w[y > 0].sum(), 2 * w / w[y < 0].sum())
        theta, bias = svm(kernel(xs, marks) @ whiten, y, w)
        beta = whiten @ theta
        return ToxicityModel(lc[at], np.add.reduceat(lv * beta[lo], at), bias, landmarks=marks, heads=heads)

    model = fit(first)
    for _ in range(rounds):

        def testify(batches: Iterator[pa.RecordBatch], m: ToxicityModel = model) -> Iterator[pa.RecordBatch]:
            known: dict[str, float] = {}
            for b in pieces(batches, "text", PIECE):
                rows = []
                for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()):
                    named = m.witnesses([s for s in SENTENCE.split(t or "") if s.strip()], known)
                    rows += [(y, u, x) for x, u in ([max(named)] if y and named else named) if u]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.float64()))], ["y", "unit", "m"])

        said = sample.select(F.col("y").cast("long").alias("y"), "text").mapInArrow(testify, "y long, unit string, m double")
        said = cut_lineage(said.groupBy("y", "unit").agg(F.count(F.lit(1)).alias("c"), F.max("m").alias("m")))
        # At most a witness per toxic document, of which there are at most `per_label`.
        toxic = said.where("y = 1 and m > 0").join(counts.select("unit", "b"), "unit", "left").where("c > coalesce(b, 0)")
        positive = first | {r["unit"]: r["c"] for r in toxic.collect()}
        worst = said.where("y = 0 and m > -1").orderBy(F.desc("m"), "unit").limit(per_label).collect()
        negative |= {r["unit"]: 4 * r["c"] for r in worst if r["unit"] not in positive}
        model = fit(positive)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for c in pieces(batches, "text", PIECE):
            yield pa.RecordBatch.from_arrays([c.column("y"), pa.array(model.texts(c.column("text").to_pylist(), cache))], ["y", "m"])

    got = sample.select(F.col("y").cast("long").alias("y"), "text").mapInArrow(margins, "y long, m double").collect()  # bounded as the sample
    yy, mm = np.array([r["y"] for r in got], float), np.array([r["m"] for r in got])
    weight = np.where(yy > 0, n1 / max(1, yy.sum()), (n - n1) / max(1, (1 - yy).sum()))
    if len(set(yy.tolist())) == 2:
        model.slope, model.shift = _calibrate(mm, yy, weight)
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every column of `docs` with `toxicity` (double, 0 to 1), from the whole text alone.

    Null text counts as empty; an existing column toxicity is replaced; repeated rows score alike; no rows give none.
    """
    d = docs.drop(*[c for c in docs.columns if c.lower() == "toxicity"])
    names = d.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for c in pieces(batches, text_col, PIECE):
            p = model.probability(model.texts(c.column(names.index(text_col)).to_pylist(), cache))
            yield pa.RecordBatch.from_arrays([*c.columns, pa.array(p)], [*names, "toxicity"])

    return d.mapInArrow(run, StructType([*d.schema.fields, StructField("toxicity", DoubleType())]))
