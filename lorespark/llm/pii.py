"""Personal data: detection by pattern, and information-theoretic sanitisation of the terms that give it away.

A detected value (an e-mail address, a number ...) is a protected entity e. Over the whole corpus, a term t tells about
it PMI(e, t) = log(n(e, t) N / (n(e) n(t))) of the IC(e) = log(N / n(e)) there is to know, where n counts the documents
that hold e, t or both, wherever they stand. Terms that stood near e in at least `support` different contexts are judged;
those that tell at least `disclose` of it are generalised in every document that holds e: to the class of all terms with
their first three letters, else to that of their first letter, whichever tells less than `disclose` whatever documents
hold both. Where no class is that vague, the term is removed.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .arrays import PIECE, pieces
from .common import reread, unused

KINDS = ("email", "ip", "card", "phone", "term")
# The contract's patterns, written without backtracking.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
#: Longer runs of letters are no words.
LONGEST = 64
NEAR = 5
BITS = 1 << 20
#: Letters that the classes of the generalisation hierarchy keep, from the narrowest class to the widest.
KEPT = (3, 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the longest run of local characters before an @ that a domain with a dot follows."""
    at, end = text.find("@"), 0
    while at >= 0:
        m = DOMAIN.match(text, at)
        start = at
        if m:
            while start > end and text[start - 1] in LOCAL:
                start -= 1
        if m and start < at:
            end = m.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := IP.search(text, at):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            yield m.span()
        at = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four kinds, in code points; leftmost and non-overlapping within each kind."""
    out = [(s, 0, e) for s, e in emails(text)] + [(s, 1, e) for s, e in ips(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


def entity(kind: int, value: str) -> str:
    """One name for the spellings of a value."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else digits_of(value)}"


def free_terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The words of a text that overlap no span; spans are sorted by start. One sweep over both."""
    at, covered, last = 0, -1, len(spans)
    for m in TERM.finditer(text):
        while at < last and spans[at][0] < m.end():
            covered = max(covered, spans[at][2])
            at += 1
        if covered <= m.start() and m.end() - m.start() <= LONGEST:
            yield m


def contexts(text: str, spans: list[tuple[int, int, int]]) -> tuple[set[tuple[str, int, str]], list[str]]:
    """(entity, hash of the words around it, one of these words) for each span, with "" where there is none; and all
    distinct words outside spans."""
    found = list(free_terms(text, spans))
    starts, terms = [m.start() for m in found], [m[0].lower() for m in found]
    hashes = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in terms]
    out = set()
    for s, kind, e in spans:
        i = bisect_left(starts, s)
        j = i if e == s else bisect_left(starts, e)
        lo, hi = max(0, i - NEAR), min(len(terms), j + NEAR)
        name, context = entity(kind, text[s:e]), zlib.crc32(repr((hashes[lo:i], hashes[j:hi])).encode())
        out.update((name, context, t) for t in set(terms[lo:i] + terms[j:hi]) or ("",))
    return out, list(dict.fromkeys(terms))


def revealing_terms(docs: DataFrame, disclose: float = 0.8, support: int = 2) -> tuple[DataFrame, DataFrame]:
    """From (doc_id, text): (entity, term, degree, class) of the terms beyond the threshold, and (doc_id, entity, term)
    of the documents that hold both. Degree is PMI / IC, 1 if every document with the term holds the entity; class is
    null where even the widest one tells too much.

    Copies count as documents, but not as further contexts. A corpus whose every document holds e has IC(e) = 0; no
    term tells more about such an e. Documents and terms meet term by term, so a frequent entity brings only terms
    that its documents hold.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("entity", pa.string()), ("context", pa.int64()), ("term", pa.string())])
        for b in pieces(batches, "text", PIECE):
            rows = []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if i is not None and text and (spans := base_spans(text)):
                    around, terms = contexts(text, spans)
                    rows.append((i, [{"entity": e, "context": c, "term": t} for e, c, t in around], terms))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.list_(pair), pa.list_(pa.string())))], ["doc_id", "near", "words"])

    seen = reread(docs.mapInArrow(near, "doc_id long, near array<struct<entity:string,context:long,term:string>>, words array<string>"))
    around = seen.select("doc_id", F.explode("near").alias("x")).select("doc_id", "x.*")
    holders = around.select("doc_id", "entity").distinct()
    owners = holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    together = around.where("term <> ''").select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
    candidates = reread(together.where(F.col("contexts") >= support))
    # A bit per hash of a candidate, at most BITS: what passes it is counted, and what passes by chance is dropped after.
    word_bits = np.zeros(BITS, bool)
    hashes = candidates.select((F.crc32(F.col("term").cast("binary")) % BITS).cast("int").alias("h")).distinct().collect()
    word_bits[[r["h"] for r in hashes]] = True

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[str, bool] = {}
        docs_here, words = 0, Counter()
        for b in pieces(batches, "text", PIECE):
            docs_here += b.num_rows
            if word_bits.any():
                for text in b.column("text").to_pylist():
                    here = {w.lower() for w in TERM.findall(text) if len(w) <= LONGEST} if text else ()
                    for w in here:
                        if w not in wanted:
                            if len(wanted) > 150_000:
                                wanted.clear()
                            wanted[w] = bool(word_bits[zlib.crc32(w.encode("utf-8", "surrogatepass")) % BITS])
                        if wanted[w]:
                            words[w] += 1
                    for kept in KEPT:
                        words.update({f"{w[:kept]}*" for w in here})
            if len(words) > 100_000:
                yield counted(words)
                words = Counter()
        words[""] = docs_here
        yield counted(words)

    def counted(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["term", "n_t"])

    totals = reread(docs.select("text").mapInArrow(count, "term string, n_t long").groupBy("term").agg(F.sum("n_t").alias("n_t")))
    n = float((totals.where("term = ''").first() or {"n_t": 0})["n_t"])

    def degree(common: Column) -> Column:
        return F.log(common * n / (F.col("n_e") * F.col("n_t"))) / F.log(n / F.col("n_e"))

    # No more than all documents of the rarer of the two can hold both.
    candidates = candidates.join(owners, "entity").join(totals, "term").where(F.col("n_e") < n)
    candidates = reread(candidates.where(degree(F.least("n_e", "n_t")) >= disclose).select("entity", "term", "n_e", "n_t"))
    held = seen.select("doc_id", F.explode("words").alias("term")).join(candidates.select("term", "entity"), "term").join(holders, ["doc_id", "entity"])
    held = reread(held.select("doc_id", "entity", "term").distinct())
    pairs = held.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
    told = candidates.join(pairs, ["entity", "term"]).withColumn("degree", degree(F.col("n_et"))).where(F.col("degree") >= disclose)
    classes = totals.where(F.col("term").endswith("*")).select(F.col("term").alias("class"), F.col("n_t").alias("n_c"))
    safe = []
    for kept in KEPT:
        name = f"class_{kept}"
        told = told.withColumn("class", F.concat(F.substring("term", 1, kept), F.lit("*"))).join(classes, "class", "left")
        # Even if all documents of the entity held a word of the class, it would tell no more than this.
        vague = F.log(n / F.col("n_c")) / F.log(n / F.col("n_e")) < disclose
        told = told.withColumn(name, F.when(vague, F.col("class"))).drop("class", "n_c")
        safe.append(F.col(name))
    return told.select("entity", "term", "degree", F.coalesce(*safe).alias("class")), held


def sanitise(docs: DataFrame, disclose: float = 0.8, support: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every column of `docs`, with `spans` (array<struct<kind,start,end,degree,replacement>>, code points, by start then
    kind) and `sanitised`: the text with e-mail addresses, IP addresses, card and phone numbers replaced by <KIND>, and
    revealing terms generalised (replacement: their class, such as abc*) or removed (replacement: empty), in all places,
    in the documents that hold what they reveal.

    Null text counts as empty (and stays null in `sanitised`); rows with null ids are searched by pattern alone; rows
    that share an id share their revealing terms; existing columns spans and sanitised are replaced, and no other name
    clashes. A pattern's matches that fail its check are dropped and not tried again. Terms that overlap a pattern's span
    are left to it; runs of more than LONGEST letters are no terms. A term that reveals several entities of a document
    takes the vaguest of its classes.
    """
    own = ("spans", "sanitised")
    d = docs.drop(*[c for c in docs.columns if c.lower() in own])
    names = d.columns
    body = names.index(text_col)
    plain = d.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    told, held = revealing_terms(plain, disclose, support)
    # The vaguest: removal (null), then the shortest class.
    vague = F.when(F.col("class").isNull(), 0).otherwise(-F.length("class"))
    flagged = held.join(told, ["entity", "term"]).groupBy("doc_id", "term").agg(F.max("degree").alias("degree"), F.max_by("class", vague).alias("class"))
    terms, owner = unused(names, "told_terms"), unused(names, "told_doc")
    flagged = flagged.groupBy(F.col("doc_id").alias(owner)).agg(F.map_from_entries(F.collect_list(F.struct("term", F.struct("degree", F.coalesce("class", F.lit("")).alias("class"))))).alias(terms))
    joined = d.join(flagged, d[f"`{id_col}`"].cast("long") == flagged[owner], "left").drop(owner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("degree", pa.float64()), ("replacement", pa.string())])
        for b in pieces(batches, names[body], PIECE):
            spans, clean = [], []
            for text, told in zip(b.column(body).to_pylist(), b.column(len(names)).to_pylist()):
                base = base_spans(text) if text else []
                found = [(s, k, e, 1.0, f"<{KINDS[k].upper()}>") for s, k, e in base]
                if told and text:
                    known = dict(told)
                    for m in free_terms(text, base):
                        if (t := known.get(m[0].lower())) is not None:
                            found.append((m.start(), 4, m.end(), t["degree"], t["class"]))
                    found.sort()
                spans.append([{"kind": KINDS[k], "start": s, "end": e, "degree": g, "replacement": r} for s, k, e, g, r in found])
                clean.append(None if text is None else masked(text, found))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(spans, pa.list_(kind)), pa.array(clean, pa.string())], [*names, *own])

    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("degree", DoubleType()), StructField("replacement", StringType())])
    return joined.mapInArrow(run, StructType([*d.schema.fields, StructField("spans", ArrayType(span)), StructField("sanitised", StringType())]))


def masked(text: str, found: list[tuple[int, int, int, float, str]]) -> str:
    """Spans may overlap across kinds; overlapping ones are masked as one, by the kind of the first."""
    out, at = [], 0
    for s, _, e, _, replacement in found:
        if s >= at:
            out += [text[at:s], replacement]
        at = max(at, e)
    return "".join(out) + text[at:]
