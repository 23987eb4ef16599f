"""Each training-data operator against a plain version, over awkward rows, and on empty tables."""

import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import frame  # noqa: F401
from pyspark.sql import functions as F

from lorespark.llm import ann, arrays, components, decontam, jaccard, packing, pii, sharding, substring, suffix, tokens, toxicity


def key(rows):
    return sorted(rows, key=str)


def test_repeated_words_equal_brute_force(docs, rows):
    got = substring.repeated_words(docs).select("doc_id", "n_words", F.size("removed"), F.sha2("kept", 256)).collect()
    assert key(tuple(r) for r in got) == key(brute.repeated_words(rows))


@pytest.mark.parametrize("window,period", [(5, 3), (8, 7), (13, 1)])
def test_repeated_words_any_cover(docs, rows, window, period):
    got = substring.repeated_words(docs, window, period).select("doc_id", "n_words", F.size("removed"), F.sha2("kept", 256)).collect()
    assert key(tuple(r) for r in got) == key(brute.repeated_words(rows, window))


def test_windows_whose_first_hashes_collide_stay_apart(spark, tmp_path):
    """A first hash that is the same for all words: all windows meet, and the second hash tells them apart."""
    import lorespark.llm.substring as module

    real = module.span_hashes
    module.span_hashes = lambda b, s, e, base=arrays.M, kind=arrays.U: real(b, s, e, base, kind) if base != arrays.M else real(b, s, e) * arrays.U(0)
    try:
        rng = np.random.default_rng(3)
        texts = [" ".join(str(x) for x in rng.integers(0, 10**6, 14)) for _ in range(400)]
        texts += texts[:20]
        b, off = arrays.texts(__import__("pyarrow").array(texts))
        s, e, first, h = module._words(b, off)
        at = np.flatnonzero(arrays.inside(first, len(h), 13))
        one, two = arrays.window_hashes(h, 13)[at], (arrays.window_hashes(real(b, s, e, arrays.M2, np.uint32), 13) >> arrays.U(32)).astype(np.uint32)[at]
        doc = arrays.row_of(first, len(h))[at].astype(np.int64)
        asked = [module._ask_smallest(i, doc[part], one[part], two[part], 2) for i, part in enumerate(np.array_split(np.arange(len(at)), 3))]
        rows = [r for batch in asked for r in batch.to_pylist()]
        got = set()
        for r in module.smallest_owner(spark.createDataFrame(rows, module.MESSAGE), 2).collect():
            got |= set(np.frombuffer(r.docs, np.int64).tolist())
        assert len(set(one.tolist())) == 1 and len(set(two.tolist())) == 800 and got == set(range(400, 420))
    finally:
        module.span_hashes = real


def test_difference_covers():
    for v in range(1, 14):
        d = substring.difference_cover(v)
        assert {(a - b) % v for a in d for b in d} == set(range(v))


@pytest.mark.parametrize("width,k", [(50, 24), (20, 8), (33, 12)])
def test_repeated_bytes_equal_brute_force(docs, rows, width, k):
    out = suffix.repeated_bytes(docs, width, k)
    got = out.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
    assert key(tuple(r) for r in got) == key(brute.repeated_bytes(rows, width))


def test_many_texts_around_one_minimiser_stay_apart(spark):
    """With 32 bits to tell contexts apart, about ten of these documents would lose all their text."""
    grams = np.random.default_rng(0).integers(97, 123, (1 << 20, 24)).astype(np.uint8)
    h = suffix.gram_hashes(grams.ravel(), 24)[::24]
    passage = grams[int(h.argmin())].tobytes().decode()  # the minimiser of nearly all windows that hold it
    n = 300_000
    texts = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.substring(F.sha2(F.col("id").cast("string").cast("binary"), 256), 1, 26), F.lit(passage)).alias("text"))
    assert suffix.repeated_bytes(texts).where(F.octet_length("kept") < F.col("n_bytes")).count() == 0


def test_logarithmic_family_levels_shrink():
    family = suffix.LogarithmicFamily(4)
    rng, seen = np.random.default_rng(0), set()
    for _ in range(40):
        body = rng.integers(97, 103, 60).astype(np.uint8)
        keys, at = np.unique(suffix.windows(body, np.arange(57), 4), return_index=True)
        old = family.holds(keys)
        assert old.tolist() == [k in seen for k in keys.tolist()]
        family.add(suffix.Level(body, at[~old], 4))
        seen |= set(keys.tolist())
        sizes = [len(x) for x in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
        assert all((x.keys[1:] > x.keys[:-1]).all() and (suffix.windows(x.body, x.at, 4) == x.keys).all() for x in family.levels)


@pytest.mark.parametrize("batch_windows", [1, 40, 1 << 16])
def test_matched_windows_scan_several_levels(batch_windows):
    rng, width = np.random.default_rng(1), 6
    texts = [bytes(rng.integers(97, 100, rng.integers(6, 30)).astype(np.uint8)) for _ in range(60)]
    lens, docs = np.array([len(t) for t in texts]), np.sort(rng.integers(0, 40, 60))
    family = suffix.LogarithmicFamily(width)
    got = suffix.matched_windows(np.frombuffer(b"".join(texts), np.uint8), lens, docs, width, batch_windows, family)
    least = {}
    for t, d in zip(texts, docs.tolist()):
        for i in range(len(t) - width + 1):
            least[t[i : i + width]] = min(least.get(t[i : i + width], d), d)
    assert got.tolist() == [least[t[i : i + width]] < d for t, d in zip(texts, docs.tolist()) for i in range(len(t) - width + 1)]
    assert sum(map(len, family.levels)) == len(least)


def test_groups_of_windows_bound_the_levels():
    """One shard with 1.5 million windows: its levels took over 200 MB at once."""
    import tracemalloc

    rng, width = np.random.default_rng(2), 50
    n = 50_000
    lens, docs = np.full(n, 80), np.sort(rng.integers(0, 20_000, n))
    body = rng.integers(97, 123, n * 80).astype(np.uint8).reshape(n, 80)
    body[rng.integers(0, n, 9000)] = body[rng.integers(0, n, 9000)]
    body, starts = body.ravel(), np.arange(n) * 80
    want = suffix.matched_windows(body, lens, docs, width)
    tracemalloc.start()
    got = suffix.matched_in_groups(body, starts, lens, docs, width, most=1 << 17)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.any() and (got == want).all()
    assert peak < 80e6


def test_segments_are_runs_of_windows_with_one_minimiser():
    rng, width, k = np.random.default_rng(4), 20, 8
    parts = [bytes(rng.integers(97, 101, n).astype(np.uint8)) for n in (0, 5, 19, 20, 21, 300_000, 0, 64, 1000)] + [b"x" * 90]
    b, off = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    row, start, count, h, key = suffix.segments(b, off, width, k)
    least = suffix.gram_hashes(b, k)
    seen = np.concatenate([np.arange(s, s + c) for s, c in zip(start.tolist(), count.tolist())])
    assert seen.tolist() == [i for r in range(len(parts)) for i in range(off[r], off[r + 1] - width + 1)]
    for r, s, c, x in zip(row[::50].tolist(), start[::50].tolist(), count[::50].tolist(), h[::50].tolist()):
        assert off[r] <= s and s + c + width - 1 <= off[r + 1]
        assert all(least[i : i + width - k + 1].min() == x for i in range(s, s + c))
    named = {}
    for s, c, x in zip(start.tolist(), count.tolist(), key.tolist()):
        assert named.setdefault(x, b[s : s + c + width - 1].tobytes()) == b[s : s + c + width - 1].tobytes()


def test_shards_follow_the_bytes_of_the_texts(docs, rows, monkeypatch):
    from lorespark.llm import exchange

    monkeypatch.setattr(exchange, "SHARD_BYTES", 1000)
    size = sum(len((t or "").encode()) for _, t in rows)
    assert exchange.shard_count(docs.select("text")) >= size / 1000
    out = suffix.repeated_bytes(docs, 20, 8)
    got = out.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
    assert key(tuple(r) for r in got) == key(brute.repeated_bytes(rows, 20))


def test_index_takes_batches_against_all_levels(spark, rows, tmp_path):
    folder, width = f"{tmp_path}/index", 20
    batches = [rows[:30], rows[30:34], [], rows[34:36], rows[36:60], rows[60:], [(5000, rows[12][1]), (5001, "a short one")]]
    held, levels = set(), []
    for n, part in enumerate(batches):
        index = suffix.SuffixIndex(spark, folder, width=width, k=8, shards=3)  # opened again each time
        got = sorted(((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) for r in index.add_batch(frame(spark, part)).collect()), key=str)
        least = {}
        for i, t in part:
            b = (t or "").encode()
            for s in range(len(b) - width + 1) if i is not None else ():
                least[b[s : s + width]] = min(least.get(b[s : s + width], i), i)
        want = []
        for i, t in part:
            b = (t or "").encode()
            gone = bytearray(len(b))
            for s in range(len(b) - width + 1) if i is not None else ():
                if b[s : s + width] in held or least[b[s : s + width]] < i:
                    gone[s : s + width] = b"\1" * width
            want.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone)))))
        assert got == sorted(want, key=str), n
        held |= set(least)
        levels.append(len(index.levels))
        assert all(a >= 2 * b for (_, a), (_, b) in zip(index.levels, index.levels[1:]))
    assert max(levels) > 1


def test_jaccard_equals_brute_force(docs, rows):
    got = jaccard.jaccard_join(docs).select("doc_id", "class_id", "group_id", "n_ngrams", "n_links").collect()
    assert key(tuple(r) for r in got) == key(brute.jaccard(rows))


@pytest.mark.parametrize("large,block", [(3, 4), (16, 512), (1000, 512)])
def test_jaccard_blocks_count_every_link(spark, monkeypatch, large, block):
    """The size from which buckets are verified in blocks doesn't change the result."""
    monkeypatch.setattr(jaccard, "LARGE_BUCKET", large)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(30):
        w = list(base)
        w[(7 * i) % 60] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(50, rows[0][1]), (51, "nothing like it at all in here")]
    got = jaccard.jaccard_join(frame(spark, rows)).select("doc_id", "class_id", "group_id", "n_ngrams", "n_links").collect()
    assert key(tuple(r) for r in got) == key(brute.jaccard(rows))


def test_bands_reach_their_recall():
    for s in (0.5, 0.8, 0.95):
        b, r = jaccard.choose_bands(s, 0.999, 512)
        assert 1 - (1 - s**r) ** b >= 0.999
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.01, 0.999, 4)


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 9), (None, 1)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 220)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8} | {i: 100 for i in range(100, 141)} | {i: 200 for i in range(200, 220)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sharding_equals_brute_force(docs, rows):
    got = sharding.shard_documents(docs, 8).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert key(tuple(r) for r in got) == key(brute.shard(rows))


@pytest.mark.parametrize("shards", [1, 3, 100])
def test_shards_are_gapless(docs, rows, shards):
    got = defaultdict(list)
    for r in sharding.shard_documents(docs, shards).collect():
        got[r.shard].append(r.slot)
    assert sum(map(len, got.values())) == len(rows) and all(sorted(x) == list(range(len(x))) for x in got.values())


def test_packing_is_an_exact_round_trip(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_vocabulary())
    got = packing.pack(docs, sequence_length=64, group_pieces=50).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == r.length
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64 and {r.sequence_tokens for r in pieces} == {at}
    want = sorted((i is None, i or 0, s, tuple(x[s : s + 64])) for i, text in rows for x in [t.encode(text or "", add_special_tokens=False).ids + [1]] for s in range(0, len(x), 64))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, tuple(r.ids)) for r in got) == want
    digest = packing.pack(docs, sequence_length=64, payload="crc32").collect()
    assert sorted((r.doc_id or 0, r.start, r.ids_crc32) for r in digest) == sorted((r.doc_id or 0, r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got)


def test_groups_do_not_depend_on_shuffle_partitions(spark):
    third = F.col("id") % 3 == 0  # a third of all rows are one repeated row
    text = F.when(third, "the same hot row").otherwise(F.repeat(F.lit("word "), (F.col("id") * 7919 % 90 + 2).cast("int")))
    rows = spark.range(12_000).select(F.when(third, -1).otherwise(F.col("id")).alias("doc_id"), text.alias("text"))
    had = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            used = packing.pack(rows, sequence_length=128, payload="crc32", group_pieces=4000).groupBy("sequence_id").agg(F.first("sequence_tokens").alias("t")).agg(F.count("t"), F.sum("t")).first()
            assert 1 - used[1] / (used[0] * 128) < 0.02, n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)


def test_tournament_tree_is_first_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 400)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        j = next((j for j, r in enumerate(room) if r >= lengths[i]), len(room))
        room += [100] * (j == len(room))
        assert (bins[i], offsets[i]) == (j, 100 - room[j])
        room[j] -= lengths[i]


@pytest.mark.parametrize("text", ["", " ", "a", "<|endoftext|>", "x<|endoftext|>y  z\n\n", "é日本" * 50, "a" * 6000, "a  b \n c\t\t d", "it's 3.14 ok", "\x1c x"])
def test_ids_equal_the_reference_tokenizer(text):
    from tokenizers import Tokenizer

    path = tokens.default_vocabulary()
    assert tokens.encode(text, path) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_length_histogram(spark, docs, rows):
    lengths = tokens.token_lengths(docs)
    n = [r.n_tokens for r in lengths.collect()]
    assert len(n) == len(rows)
    got = {r.n_tokens: r for r in tokens.length_histogram(lengths, block=16).collect()}
    assert set(got) == set(n)
    for x, r in got.items():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (n.count(x), sum(y >= x for y in n), sum(y for y in n if y >= x))
        assert r.truncated_total == sum(min(x, y) for y in n) and r.quantile == pytest.approx(sum(y <= x for y in n) / len(n))
    limits = [0, 1, 7, 100, 10**6, 7]
    asked = tokens.at_limits(tokens.length_histogram(lengths), limits).collect()
    want = sorted((x, len(n), sum(n), sum(y > x for y in n), sum(min(x, y) for y in n), sum(max(0, y - x) for y in n)) for x in limits)
    assert sorted(map(tuple, asked)) == want
    nothing = tokens.length_histogram(lengths.limit(0))
    assert tuple(tokens.at_limits(nothing, [5]).first()) == (5, 0, 0, 0, 0, 0) and tokens.at_limits(nothing, []).count() == 0


def plain_spans(text):
    """The four patterns as the contract states them."""
    out = []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (12 <= len(digits) <= 19 and luhn) or k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_patterns_equal_plain_ones():
    rng = np.random.default_rng(2)
    alphabet = list("aZ9@@..--++  ()_%é\n") + ["4111 1111 1111 1111", "+1 (555) 010-1234", "10.0.255.256", "x.y@ex-a.com", "192.168.0.1", "0001.2.3.4"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, 25))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii_masks_and_reveals(spark):
    filler = [f"plain words number {chr(97 + i % 26)}{chr(97 + i // 26)} stand here alone" for i in range(60)]
    texts = ["ask zebedee smith at zs@example.org today", "write zebedee once more zs@example.org please", "the agent zebedee sits with zs@example.org now", "call +44 20 7946 0958 or 10.1.2.3", None, "", *filler]
    docs = frame(spark, list(enumerate(texts)) + [(None, "a@b.cd"), (0, texts[0])])
    got = [(r.doc_id, r.spans, r.sanitised) for r in pii.sanitise(docs).collect()]
    assert len(got) == len(texts) + 2
    for i, spans, clean in got:
        text = "a@b.cd" if i is None else texts[i]
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in spans if s.kind != "term"] == plain_spans(text or "")
        assert (clean is None) == (text is None)
        told = [text[s.start : s.end] for s in spans if s.kind == "term"]
        assert ("zebedee" in told) == (i in (0, 1, 2)) and "plain" not in told
        if i in (0, 1, 2):
            assert "zs@" not in clean and "zebedee" not in clean and "<EMAIL>" in clean
        elif i is not None and i > 5:
            assert clean == text
    assert "<PHONE>" in dict((i, c) for i, _, c in got)[3]


def plain_terms(rows, disclose=0.8, support=2):
    """{row: {term: class or ""}} by counting everything in dictionaries."""
    import math

    held, words, contexts = {}, [], defaultdict(set)
    for i, t in rows:
        t = t or ""
        spans = plain_spans(t)
        free = [m for m in re.finditer(r"[^\W\d_]{3,}", t) if m.end() - m.start() <= 64 and not any(s < m.end() and m.start() < e for s, _, e in spans)]
        for s, k, e in spans if i is not None else ():
            name = pii.entity(k, t[s:e])
            held.setdefault(i, (set(), set()))[0].add(name)
            held[i][1].update(m[0].lower() for m in free)
            left, right = [m[0].lower() for m in free if m.start() < s][-5:], [m[0].lower() for m in free if m.start() >= e][:5]
            for w in left + right:
                contexts[name, w].add((tuple(left), tuple(right)))
        words.append({m.lower() for m in re.findall(r"[^\W\d_]{3,}", t) if len(m) <= 64})
    n, out = len(rows), defaultdict(dict)
    for (e, w), c in contexts.items():
        n_e, both = sum(e in x for x, _ in held.values()), sum(e in x and w in y for x, y in held.values())
        n_t = sum(w in x for x in words)
        if len(c) < support or n_e >= n or not both or math.log(both * n / (n_e * n_t)) / math.log(n / n_e) < disclose - 1e-12:
            continue
        best = ""
        for kept in (3, 1):
            n_c = sum(any(x[:kept] == w[:kept] for x in d) for d in words)
            if math.log(n / n_c) / math.log(n / n_e) < disclose:
                best = w[:kept] + "*"
                break
        for i, (x, y) in held.items():
            if e in x and w in y:
                had = out[i].get(w)
                out[i][w] = best if had is None else min(had, best, key=len)
    return out


def test_revealing_terms_equal_counting(spark):
    rng = np.random.default_rng(20)
    vocabulary = ["".join(rng.choice(list("abcdeilmnorst"), rng.integers(3, 7))) for _ in range(150)]
    people = [(f"zach{x}", f"{"jqpv"[i]}{x}uill", f"z{i}@ex.org") for i, x in enumerate("abcd")] + [(f"marelda{x}", f"u{x}ndertow", f"+44 20 7946 0{i:03d}") for i, x in enumerate("abcd")]
    rows = []
    for i in range(260):
        w = [str(x) for x in rng.choice(vocabulary, rng.integers(4, 60))]
        if i % 3 == 0:
            a, b, value = people[i // 3 % len(people)]
            at = int(rng.integers(len(w)))
            w[at:at] = [a, value] if i % 2 else [a, b, value]
            if i % 9 == 0:
                w += ["filler"] * 12 + [b]  # far from the value
        rows.append((i, " ".join(w)))
    rows += [(0, None), (3, None), (None, "who z0@ex.org quillfeather"), (7, "x" * 200 + " z1@ex.org " + "x" * 200), (8, ""), (9, rows[9][1])]
    want, spans = plain_terms(rows), 0
    for r in pii.sanitise(frame(spark, rows)).collect():
        told = {}
        for s in r.spans:
            if s.kind == "term":
                told[r.text[s.start : s.end].lower()] = s.replacement
                spans += 1
        here = {w: c for w, c in want[r.doc_id].items() if w in re.findall(r"[^\W\d_]{3,}", (r.text or "").lower())} if r.doc_id is not None else {}
        assert told == here, r.doc_id
    kinds = {c for x in want.values() for c in x.values()}
    assert spans and "" in kinds and any(c.endswith("*") for c in kinds)


def test_pii_is_linear_in_spans_and_takes_any_text():
    import time

    took = []
    for n in (4_000, 16_000):
        text = "".join(f"user{i}@mail{i}.example.org, " for i in range(n)) + "x" * 100_000
        began = time.time()
        spans = pii.base_spans(text)
        around, words = pii.contexts(text, spans)
        took.append(time.time() - began)
        assert len(spans) == n and len({e for e, _, _ in around}) == n
    assert took[1] < 12 * took[0] + 0.5
    assert pii.contexts("+49 30 1234567 \ud800 a\0b", pii.base_spans("+49 30 1234567 \ud800 a\0b"))[1] == []


def toxic_sample(spark):
    rng = np.random.default_rng(4)
    good = ["".join(rng.choice(list("aeiounrstl"), rng.integers(2, 8))) for _ in range(400)]
    bad = ["grublok", "snirvex", "pobzak"]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(good, rng.integers(5, 60)))
        y = int(i % 5 == 0)
        if y:
            w[int(rng.integers(len(w)))] = bad[i % 3]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, y))
    return rows, labels, good


def test_toxicity_learns_and_tolerates_disguise(spark):
    rows, labels, good = toxic_sample(spark)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, rows), lab)
    probes = rows + [(1000, None), (1001, ""), (1002, "you grub-lok there"), (1003, "so snirrvex it is"), (1004, "p o b z a k"), (1005, " ".join(good[:300])), (1006, "grublok " + "x" * 3000)]
    out = toxicity.score(frame(spark, probes), model)
    assert [c.lower() for c in out.columns].count("toxicity") == 1
    got = {r.doc_id: r.toxicity for r in out.collect()}
    assert all(0 <= p <= 1 for p in got.values())
    held = [(got[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((p >= 0.5) == bool(y) for p, y in held)
    assert all(got[i] >= 0.5 for i in (1002, 1003, 1004, 1006)) and all(got[i] < 0.5 for i in (1000, 1001, 1005))


def test_toxicity_of_pairs_and_odd_characters(spark):
    """Two words that are harmless alone, a NUL inside words, characters beyond 16 bits."""
    rows, labels, good = toxic_sample(spark)
    rng = np.random.default_rng(14)
    pair = ("velmar", "tonspik")
    extra, told = [], []
    for i in range(2000, 2400):
        w = list(rng.choice(good, 30))
        if i % 4 == 0:
            w[9:9] = pair
        else:
            w.insert(3, pair[0]), w.insert(20, pair[1])
        extra.append((i, " ".join(w))), told.append((i, 1, int(i % 4 == 0)))
    model = toxicity.train(frame(spark, rows + extra), spark.createDataFrame(labels + told, "doc_id long, quality int, toxic int"))
    probes = [(0, "see velmar tonspik here"), (1, "tonspik and then velmar"), (2, "a\0b grublok c\0\0d"), (3, "\0"), (4, "\U0001f600\U0001f600\U0001f600\U0001f600 " + good[0])]
    got = {r.doc_id: r.toxicity >= 0.5 for r in toxicity.score(frame(spark, probes), model).collect()}
    assert got == {0: True, 1: False, 2: True, 3: False, 4: False}
    a, b = toxicity.features(["\U00010041\U00010042\U00010043\U00010044"])[1], toxicity.features(["ABCD"])[1]
    assert not set(a.tolist()) & set(b.tolist())


def test_toxicity_of_no_texts(spark, empty):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for d in (empty, frame(spark, [(1, None), (2, None)]), frame(spark, [(1, ""), (2, " ")]), frame(spark, [(1, None), (2, "only clean text")])):
        model = toxicity.train(d, labels, hold_out=0)
        assert {round(r.toxicity, 6) for r in toxicity.score(frame(spark, [(5, None), (6, "x")]), model).collect()} == {0.5}


def test_toxicity_held_out_on_the_real_table(spark):
    """Some labels are wrong, so perfection can't be had; one insult word list would do no better."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels)).join(labels, "doc_id").where("toxic is not null").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    rows = scored.select("toxic", "toxicity").collect()
    bad, good = [r.toxicity for r in rows if r.toxic], [r.toxicity for r in rows if not r.toxic]
    assert sum((x > y) + 0.5 * (x == y) for x in bad for y in good) / (len(bad) * len(good)) > 0.8


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert {r.toxicity < 1e-6 for r in toxicity.score(docs, model).collect()} == {True}
    assert toxicity.score(empty, model).count() == 0


def test_kernel_counts_gapped_subsequences():
    same = toxicity.kernel(["idiot", "idxiot", "sunny"], ["idiot"])[:, 0]
    assert same[0] > same[1] > same[2]
    units = ["idiot", "stupid", "ab", "x"]
    m = toxicity.ToxicityModel()
    gram = toxicity.kernel(units, units)
    assert np.allclose(gram, gram.T) and np.linalg.eigvalsh(gram).min() > -1e-9 and len(m.units(units)) == 4


def test_leaks_are_found_and_clean_text_is_not(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9))) for _ in range(3000)]
    items = [(i, " ".join(rng.choice(words, rng.integers(15, 50)))) for i in range(20)]
    docs, want = [], set()
    for i in range(300):
        w = list(rng.choice(words, rng.integers(30, 300)))
        if i % 6 == 0:
            item = items[i // 6 % 20]
            part = [x if rng.random() > 0.1 else "other" for x in item[1].split() if rng.random() > 0.05] if i % 12 else item[1].upper().split()
            w[10:10] = part
            want.add((i, item[0]))
        docs.append((i, " ".join(w)))
    docs += [(900, None), (901, ""), (902, items[3][1]), (None, items[4][1])]
    bench = spark.createDataFrame(items + [(None, "a b c"), (77, None), (78, " ")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(frame(spark, docs), bench).collect()}
    assert got == want | {(902, 3), (None, 4)}


LENGTHS = [10, 16, 31, 33, 60, 120, 240, 500, 1000, 2000]


@pytest.mark.parametrize("lengths", [LENGTHS, LENGTHS[:1], [120], LENGTHS[-1:]], ids=["mixed", "short", "long", "longest"])
def test_leaks_equal_comparing_everything(spark, lengths, monkeypatch):
    """Verbatim and paraphrased copies of items of any length, alone and mixed, against a plain search that compares
    every passage's surroundings with every item."""
    if len(lengths) > 1:
        monkeypatch.setattr(decontam, "BENCHMARK_CHARS", 12_000)  # several parts
    rng = np.random.default_rng(16)
    words = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(3, 9))) for _ in range(6000)]
    items = [(10 * k + j, [str(x) for x in rng.choice(words, n)]) for k, n in enumerate(lengths) for j in range(2 if n < 1000 else 1)]
    docs, planted = [], set()
    for i in range(150):
        w = [str(x) for x in rng.choice(words, rng.integers(30, 300))]
        if i % 3 == 0:
            item, copy = items[i // 3 % len(items)], []
            for x in item[1]:
                u = rng.random() if i % 2 else 1.0  # odd documents hold a paraphrase
                copy += [f"other{len(copy)}"] if u < 0.15 else [] if u < 0.2 else ["very", x] if u < 0.25 else [x]
            w[20:20] = copy
            planted.add((i, item[0]))
        docs.append((i, " ".join(w)))
    df = defaultdict(int)
    for _, t in docs:
        t = t.split()
        for k in range(0, len(t), decontam.BLOCK):
            for x in set(t[k : k + decontam.BLOCK]):
                df[x] += 1
    want = set()
    for i, text in docs:
        t = text.split()
        for item, w in items:
            order, n = list(dict.fromkeys(w)), len(w)
            answer = set(sorted(order, key=lambda x: df[x])[: max(1, len(order) // 3)])
            if 2 * len(answer & set(t)) < len(answer):
                continue
            masks, wide = defaultdict(int), n + max(decontam.BLOCK, n // 4)
            for p, x in enumerate(w):
                masks[x] |= 1 << p
            for k in range(0, len(t), decontam.BLOCK):
                near = t[max(0, k - wide) : k + 2 * decontam.BLOCK + wide]
                if 2 * len(answer & set(near)) >= len(answer) and decontam.lcs(masks, n, near) >= 0.6 * n:
                    want.add((i, item))
                    break
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(frame(spark, docs), bench).collect()}
    verbatim = {(i, x) for i, x in planted if i % 2 == 0}
    assert verbatim <= got <= want and len(got & planted) >= 0.9 * len(planted) and len(got) >= 0.95 * len(want)


def test_told_at_most_bounds_what_answers_tell():
    """Never less than the distinct answer words around a passage, for any number of items at a time, and no more than
    those of the blocks around: passages far from all answers are ruled out without a look at their words."""
    rng = np.random.default_rng(26)
    size, lengths = 90, [10, 50, 200, 31]
    answers = [set(rng.choice(size, n).tolist()) for n in (3, 8, 20, 5)]
    w = np.concatenate([rng.integers(0, size + 1, n) for n in (700, 1, 40, 333)] + [np.full(3000, size)])
    off = np.array([0, 700, 700, 701, 741, 1074, 4074])
    block, first = decontam.blocks(off)
    around = np.array([n + max(decontam.BLOCK, n // 4) for n in lengths])
    passage, item = (x.ravel() for x in np.meshgrid(np.arange(first[-1]), np.arange(len(lengths)), indexing="ij"))
    doc = np.searchsorted(first, passage, "right") - 1
    got = decontam.told_at_most(w, block, first, *decontam.holders_of(answers, size), around, passage, item, doc)
    for p, i, r, n in zip(passage.tolist(), item.tolist(), doc.tolist(), got.tolist()):
        start = int(off[r]) + (p - int(first[r])) * decontam.BLOCK
        near = w[max(int(off[r]), start - around[i]) : min(int(off[r + 1]), start + 2 * decontam.BLOCK + around[i])].tolist()
        assert len(answers[i].intersection(near)) <= n and (r < 5 or n == 0)


def test_added_rows_equal_a_plain_sum():
    rng = np.random.default_rng(27)
    for many in (0, 1, 50, 5000):  # few and many rows a key
        key, rows = np.sort(rng.integers(0, 40, many)), rng.standard_normal((30, 5))
        pick, factor = rng.integers(0, 30, many), rng.random(many)
        want = np.zeros((40, 5))
        np.add.at(want, key, rows[pick] * factor[:, None])
        for at_once in (3, 1024):
            assert np.allclose(decontam.add_rows(np.zeros((40, 5)), key, rows, pick, factor, at_once), want)


def test_lcs_bits():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 30)).tolist(), rng.integers(0, 5, rng.integers(0, 40)).tolist()
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        masks = {}
        for p, c in enumerate(a):
            masks[c] = masks.get(c, 0) | 1 << p
        assert decontam.lcs(masks, len(a), b) == t[-1, -1]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, None) for i, v in rows], "vec_id long, embedding array<float>, rank string, dim string")


def test_neighbours_recall_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[300:500] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2100, []), (2200, [0.0] * 16), (2300, [float("nan")] * 16), (2400, [1.0, None] * 8), (2500, [float("inf")] * 16), (None, [1.0] * 16), (2600, [1.0, 2.0]), (2700, [1.5, 2.0]), (0, rows[0][1])]
    got = defaultdict(list)
    for r in ann.nearest(vectors(spark, rows + odd), k=10, every=100).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 100)) | {2600, 2700}
    d64, hit = x.astype(float), 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((d64 - d64[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(1500), d)).tolist() if i != q][:10]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11)) and all(s == d[i] for _, i, s in mine)
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hit += len(set(want) & {i for _, i, _ in mine})
    assert hit >= 0.9 * 150
    assert [i for _, i, _ in sorted(got[300])] == [7, *range(301, 310)]
    assert got[2600] == [(1, 2700, 0.5)] and got[2700] == [(1, 2600, 0.5)]


def test_neighbours_keep_rows_that_share_an_id_or_a_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [4.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 3.0])]
    got = sorted((r.query_id, r.score, r["rank"], r.vec_id) for r in ann.nearest(vectors(spark, rows), k=10).collect())
    first = [(0, 0.0, 1, 0), (0, 0.0, 2, 5), (0, 3.0, 3, 0), (0, 3.0, 4, 6)]
    second = [(0, 3.0, 1, 0), (0, 3.0, 2, 0), (0, 3.0, 3, 5), (0, 18**0.5, 4, 6)]
    assert got == sorted(first + second)


@pytest.mark.parametrize("unit", [True, False])
def test_collisions_spare_most_exact_distances(unit):
    """Unclustered vectors are the hardest case: the tenth neighbour is hardly nearer than the rest."""
    x = np.random.default_rng(12).standard_normal((4096, 64))
    if unit:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    index, hit = ann.CollisionIndex(np.arange(4096), x), 0
    for q in range(0, 4096, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hit += len(set(np.argsort(d)[:10].tolist()) & {i for _, i in index.search(x[q], q, 10)})
    assert hit >= 0.9 * 410
    assert index.verified < 0.1 * 41 * 4096


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    lengths = tokens.token_lengths(empty)
    results = [substring.repeated_words(empty), suffix.repeated_bytes(empty), jaccard.jaccard_join(empty), sharding.shard_documents(empty), packing.pack(empty), lengths, tokens.length_histogram(lengths), pii.sanitise(empty), decontam.find_leaks(empty, none), ann.nearest(vectors(spark, []))]
    results.append(decontam.find_leaks(empty, spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")))
    assert [r.count() for r in results] == [0] * len(results)


def test_hashes_do_not_depend_on_place():
    import pyarrow as pa

    one = arrays.texts(pa.array(["alpha beta", None, "", "beta"]))
    s, e, first = arrays.word_spans(*one)
    h = arrays.span_hashes(one[0], s, e)
    assert first.tolist() == [0, 2, 2, 2, 3] and h[1] == h[2] != h[0]


def test_whole_pieces_stay_out_of_groups(spark):
    """A few very long documents: their whole pieces are sequences of their own, and only remainders meet in groups."""
    rows = [(i, "one two three four five " * 3000) for i in range(6)] + [(6, "short")]
    out = packing.pack(frame(spark, rows), sequence_length=256, group_pieces=4)
    got = out.collect()
    whole = [r for r in got if r.length == 256]
    assert len(whole) > 300 and len({r.sequence_id for r in whole}) == len(whole) and all(r.offset == 0 and r.sequence_tokens == 256 for r in whole)
    assert not {r.sequence_id for r in whole} & {r.sequence_id for r in got if r.length < 256}
    for i, text in rows:
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert sum((r.ids for r in mine), []) == [*tokens.encode(text, tokens.default_vocabulary()), 1]


def test_long_texts_beside_many_short_ones(spark):
    """Texts of several pieces' size, in one batch with short ones, through every operator that cuts batches by bytes."""
    long = "write to someone@example.org now " * 40_000
    rows = [(i, long if i in (3, 7) else f"word{i} other") for i in range(12)] + [(20, None), (21, "")]
    d = frame(spark, rows)
    spans = {r.doc_id: len(r.spans) for r in pii.sanitise(d).select("doc_id", "spans").collect()}
    assert spans[3] == spans[7] >= 40_000 and spans[0] == spans[20] == 0
    counts = {r.doc_id: r.n_tokens for r in tokens.token_lengths(d).collect()}
    assert counts[3] == counts[7] > 200_000 and counts[20] == counts[21] == 0
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")], "item_id long, text string")
    planted = frame(spark, [(30, long + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), *rows])
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(planted, bench).collect()] == [(30, 1)]
