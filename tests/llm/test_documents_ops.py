"""The operators on documents against plain versions of their contracts, and on awkward tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from maskwright.llm import decontaminate, kneser_ney, langid, line_dedup, media, near_dup, packing, secrets
from maskwright.llm.queries import tokenizer_path
from tests.llm.conftest import AWKWARD

BLANKS = " \t\n\v\f\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ---- 1 media


def test_media_round_trips():
    rng = np.random.default_rng(1)
    for shape in ((5, 7), (64, 64), (1, 1), (3, 4, 3)):
        image = rng.integers(0, 256, shape, dtype=np.uint8)
        assert (media.decode(media.encode_netpbm(image)) == image).all()
        assert (media.decode(media.encode_bmp(image)) == image).all()
    assert media.decode(b"P2\n# note\n2 2\n255\n1 2\n3 4\n").tolist() == [[1, 2], [3, 4]]
    assert media.decode(b"P1\n2 1\n1 0\n").tolist() == [[0, 255]]
    assert media.decode(b"P4\n9 1\n\x80\x80").tolist() == [[0] + [255] * 7 + [0]]
    with pytest.raises(ValueError):
        media.decode(b"GIF89a")


def _bmp(depth, width, height, body, palette=b"", packing=0, masks=b""):
    import struct

    start = 14 + 40 + len(masks) + len(palette)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, depth, packing, len(body), 0, 0, len(palette) // 4, 0)
    return struct.pack("<2sIHHI", b"BM", start + len(body), 0, 0, start) + info + masks + palette + body


def test_kinds_of_images():
    assert media.decode(b"P2\n2 2\n255\n1 2 # note 7 8\n3 4\n").tolist() == [[1, 2], [3, 4]]
    assert media.decode(b"P1 3 1 1#0 0\n01").tolist() == [[0, 255, 0]]
    image, top = media.read_image(b"P5 2 1 65535\n" + b"\x03\xe8\xff\xff")
    assert image.tolist() == [[1000, 65535]] and top == 65535
    assert media.tile(image, 2, top)[0].tolist() == [4, 255] and media.tile(np.array([[0, 15]]), 2, 15)[0].tolist() == [0, 255]
    greys = b"".join(bytes([v, v, v, 0]) for v in (10, 20))
    colours = b"".join(bytes([b, g, r, 0]) for r, g, b in ((1, 2, 3), (4, 5, 6), (7, 8, 9), (10, 11, 12)))
    assert media.decode(_bmp(1, 3, 2, b"\xa0\0\0\0\x40\0\0\0", greys)).tolist() == [[10, 20, 10], [20, 10, 20]]
    assert media.decode(_bmp(4, 3, -1, b"\x12\x30\0\0", colours)).tolist() == [[[4, 5, 6], [7, 8, 9], [10, 11, 12]]]
    assert media.decode(_bmp(8, 4, 2, b"\x03\x01\0\0\0\x03\x01\x02\x03\0\0\x01", colours, 1))[:, :, 0].tolist() == [[4, 7, 10, 1], [4, 4, 4, 1]]
    assert media.decode(_bmp(4, 4, 1, b"\x04\x12\0\x01", colours, 2))[:, :, 0].tolist() == [[4, 7, 4, 7]]
    assert media.decode(_bmp(16, 1, 1, b"\x1f\x7c\0\0")).tolist() == [[[255, 0, 255]]]
    fields = np.array([0xFF, 0xFF00, 0xFF0000], dtype="<u4").tobytes()
    assert media.decode(_bmp(32, 1, 1, b"\x01\x02\x03\x04", packing=3, masks=fields)).tolist() == [[[1, 2, 3]]]


def test_damaged_images_are_told(spark, tmp_path):
    good = media.encode_netpbm(np.zeros((2, 64), dtype=np.uint8))
    raws = [good, good[:-1], b"P2 2 1 255 1 x", b"P5 1 1 0 a", b"BM", _bmp(2, 1, 1, b"\0" * 4), _bmp(8, 1, 1, b"\x09\0\0\0", b"\0" * 8), b"GIF89a", b"", None]
    rows = media.media_features(spark.createDataFrame([(i, 0, r) for i, r in enumerate(raws)], "doc_id long, n_bytes long, media binary"), str(tmp_path)).collect()
    assert len(rows) == len(raws) and {r.doc_id for r in rows if r.error is None} == {0}
    assert all(r.payload_sha256 is None and r.tile_row is None for r in rows if r.error)


def test_area_resize_is_the_mean_of_what_is_below():
    image = np.random.default_rng(2).integers(0, 256, (12, 18)).astype(float)
    small = media.area_resize(image, 4, 6)
    assert np.allclose(small, image.reshape(4, 3, 6, 3).mean(axis=(1, 3)))
    fine = np.kron(image, np.ones((5, 7)))  # fractional cells: the same reduction of a finer copy
    assert np.allclose(media.area_resize(image, 5, 7), fine.reshape(5, 12, 7, 18).mean(axis=(1, 3)))
    assert np.allclose(media.area_resize(image, 24, 36), np.kron(image, np.ones((2, 2))))


def test_media_of_texts(spark, awkward, nothing, tmp_path):
    got = media.media_features(media.store_texts(awkward), str(tmp_path)).collect()
    want = Counter()
    for i, text in AWKWARD:
        raw = (text or "").encode()
        padded = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        want[i, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    for r in got:
        stack = np.load(tmp_path / r.tile_file)
        assert hashlib.sha256(media.npy_bytes(stack[r.tile_row])).hexdigest() == r.tile_sha256
    assert len({r.feature for r in got if r.doc_id in (10, 11)}) == 1
    assert media.media_features(media.store_texts(nothing)).count() == 0


# ---- 2 near-duplicates


def brute_near(docs, percent=85):
    sets = []
    for _, text in docs:
        words = [w for w in lower(text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    out = Counter()
    for k, (i, _) in enumerate(docs):
        ids = [docs[m][0] for m in range(len(docs)) if group[m] == group[k] and docs[m][0] is not None]
        out[i, len(sets[k]), min(ids) if ids else None] += 1
    return out


def near_rows(df, **kw):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, **kw).collect())


def test_near_duplicates(spark, corpus, awkward, nothing):
    frame, _, docs, _ = corpus
    assert near_rows(frame) == brute_near([(i, t) for i, t, _ in docs])
    assert near_rows(awkward) == brute_near(AWKWARD)
    assert near_dup.near_duplicates(nothing).count() == 0


def star(n, shift=0):
    """A star of near copies around one base, and a chain that leaves the base step by step."""
    base = [f"w{k}" for k in range(120)]
    docs = [(0, " ".join(base))]
    for k in range(1, n):  # each is linked with the base, few with one another
        copy = list(base)
        copy[(k * 7) % 120], copy[(k * 7 + 40 + k // 120) % 120] = f"x{k}", f"y{k}"
        docs.append((k, " ".join(copy)))
    chain = list(base)
    for k in range(n, n + 6):
        chain = [*chain[6:], *[f"c{k}_{m}" for m in range(6)]]
        docs.append((k, " ".join(chain)))
    return docs


def test_large_clumps(spark, monkeypatch):
    """Settled without ever holding the clump in one task."""
    docs = star(40)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for size, levels in ((6, 2), (1, 0)):
        monkeypatch.setattr(near_dup, "CLUMP_DOCS", size)
        monkeypatch.setattr(near_dup, "LEVELS", levels)
        assert near_rows(frame) == brute_near(docs)


def test_dense_regions_go_deeper(spark, monkeypatch):
    """Regions of a handful of rows at most are compared whole: all else by neighbours and division."""
    monkeypatch.setattr(near_dup, "REGION", 3)
    monkeypatch.setattr(near_dup, "LEVELS", 3)
    docs = star(40)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(near_dup, "BROADCAST_KEYS", -1)  # all joins by shuffle
    assert near_rows(frame) == brute_near(docs)


def test_ids_that_are_null_or_not_distinct(spark):
    words = " ".join(f"w{k}" for k in range(50))
    docs = [(1, words), (1, "another text of the same id, and not a short one"), (None, words + " end"), (None, "only null ids have this text"), (None, "only null ids have this text"), (7, "another text of the same id, and not a short one!")]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(1, 46, 1, True), (1, 7, 1, True), (None, 47, 1, False), (None, 2, None, True), (7, 7, 7, True)}


def test_neighbours_are_linked_across_batches():
    import pyarrow as pa

    rng = np.random.default_rng(13)
    table = rng.integers(0, 256, (9, near_dup.HASHES), dtype=np.uint8)
    table[4], table[6] = table[3], table[3]  # neighbours at distances 1 and 3, the latter in another batch
    columns = [pa.array([7] * 9), pa.array(range(9)), pa.array(range(9)), pa.array([r.tobytes() for r in table], pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, ["key", "node", "label", "sketch"])
    found = {tuple(sorted(x)) for out in near_dup._neighbours(0.62)(iter([batch.slice(0, 5), batch.slice(5)])) for x in zip(*(c.to_pylist() for c in out.columns))}
    assert found in ({(3, 4), (3, 6)}, {(3, 4), (4, 6)})


def test_recall_in_a_dense_run(spark):
    """12,000 texts of one template, no two of them linked but 400 planted pairs at 0.85 to 0.9: at least 0.99 are found."""
    rng = np.random.default_rng(14)
    template = [f"t{k}" for k in range(130)]
    texts, want = [], {}
    for k in range(12_000):
        own = [f"o{k}_{m}" for m in range(70)]
        texts.append(template + own)
    for k in range(400):
        copy = list(texts[k])
        copy[int(rng.integers(0, 60))], copy[int(rng.integers(65, 125))] = f"p{k}", f"q{k}"
        copy[int(rng.integers(135, 195))] = f"r{k}"
        want[len(texts)] = k
        texts.append(copy)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    sets = lambda t: {tuple(t[j : j + 5]) for j in range(len(t) - 4)}
    for a, b in want.items():
        x, y = sets(texts[a]), sets(texts[b])
        assert 0.85 <= len(x & y) / len(x | y) <= 0.9
    assert len(sets(texts[0]) & sets(texts[1])) / len(sets(texts[0]) | sets(texts[1])) < 0.6
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame).collect()}
    assert all(c == i or want.get(i) == c for i, c in got.items())
    assert sum(got[i] == c for i, c in want.items()) >= 0.99 * len(want)


def test_sketches_of_linked_pairs_agree_far_enough():
    from math import comb

    n = near_dup.HASHES
    for percent in (80, 85):
        floor = percent / 100 - near_dup.MARGIN
        missed = sum(comb(n, k) * (percent / 100) ** k * (1 - percent / 100) ** (n - k) for k in range(n + 1) if k / n < floor)
        assert missed < 2e-6 if percent == 80 else missed < 1e-7


# ---- 4 repeated lines


def brute_lines(docs, least):
    keys = [[lower(line.strip(BLANKS)) for line in (t or "").split("\n")] for _, t in docs]
    seen = Counter(k for ks in keys for k in set(ks) if k)
    out = Counter()
    for (i, t), ks in zip(docs, keys):
        kept = [line for line, k in zip((t or "").split("\n"), ks) if not k or seen[k] < least]
        out[i, len(ks), len(ks) - len(kept), "\n".join(kept)] += 1
    return out


def line_rows(df, **kw):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.drop_repeated_lines(df, **kw).collect())


def test_repeated_lines(spark, corpus, awkward, nothing, monkeypatch):
    frame, _, docs, _ = corpus
    docs = [(i, t) for i, t, _ in docs]
    assert line_rows(frame) == brute_lines(docs, 10)
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", -1)  # drop lists by shuffle
    assert line_rows(frame, batches=7) == brute_lines(docs, 10)
    assert line_rows(awkward, min_docs=2) == brute_lines(AWKWARD, 2)
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    carried = line_dedup.drop_repeated_lines(awkward, carry=["n_lines", "path"])
    assert carried.columns[4:] == ["n_lines", "path"] and carried.count() == len(AWKWARD)


def test_lines_known_from_earlier_batches(spark):
    """A line that becomes frequent late goes from early batches too, one known from an earlier corpus at once."""
    docs = [(k, f"often\nline {k}\n" + ("late" if k > 27 else "")) for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for batches in (1, 3, 8):
        assert line_rows(frame, batches=batches) == brute_lines(docs, 10)
    runs = line_dedup.LineRuns(spark)
    list(line_dedup.drop_repeated_lines(frame, runs=runs).collect())
    again = line_dedup.drop_repeated_lines(spark.createDataFrame([(99, "OFTEN \nnew")], "doc_id long, text string"), runs=runs).collect()
    assert [(r.doc_id, r.n_dropped, r.kept_text) for r in again] == [(99, 1, "new")]


def test_line_runs_compact_and_anti_join(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    tables = [line_dedup.line_key_table(spark.createDataFrame([(b, f"common\nonly {b}")], "doc_id long, text string")) for b in range(5)]
    for b, keys in enumerate(tables):
        assert runs.unseen(keys).count() == (2 if b == 0 else 1)  # the common line is known from the first batch on
        runs.ingest(keys)
    assert {level: len(r) for level, r in runs.levels.items() if r} == {0: 1, 2: 1}
    assert sorted(r.n for r in runs.counts().collect()) == [1, 1, 1, 1, 1, 5]


# ---- 6 packing


def test_packing(spark, corpus, awkward, nothing):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    marked = [(1, "a <|endoftext|> b"), (2, "x<|startoftext|>y <|ENDOFTEXT|> z."), (3, "<|endoftext|>")]
    assert plain.encode(marked[0][1], add_special_tokens=False).ids == [320, 49407, 321]
    for frame, docs in ((corpus[0], [(i, t) for i, t, _ in corpus[2]]), (awkward, AWKWARD), (spark.createDataFrame(marked, "doc_id long, text string"), marked)):
        ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs}
        rows = packing.pack_sequences(frame, tokenizer_path(), group_docs=50).collect()
        total = Counter()
        for r in rows:
            piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes()
            assert len(piece) == 4 * r.length and zlib.crc32(piece) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
            total[r.doc_id] += r.length
        assert total == sum((Counter({i: len(ids[i])}) for i, _ in docs), Counter())
        by_sequence = {}
        for r in rows:
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for pieces in by_sequence.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= 4096
    assert packing.pack_sequences(nothing, tokenizer_path()).count() == 0


def test_word_cache_equals_the_tokenizer(monkeypatch):
    import random

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(packing, "CACHE_WORDS", 300)  # words come back from the older generation, and go
    cache = packing.WordCache(tokenizer_path())
    rnd = random.Random(3)
    pool = [chr(c) for c in [*range(1, 384), 0x301, 0x308, 0x1100, 0x1161, 0x2028, 0x3000, 0x3A3, 0x130, 0x4E2D, 0x1F600, 0x200B]] + [" ", "\n", "'s", "<|endoftext|>", "<|startoftext|>"]
    for _ in range(50):
        texts = ["".join(rnd.choice(pool) for _ in range(40)) for _ in range(9)] + [" ".join(rnd.choice(["the", "tree.", "x1,", "<|startoftext|>", "A,."]) for _ in range(9))]
        for text, ids in zip(texts, cache.encode_all(texts)):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_first_fit_decreasing():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, 500)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    rooms, want = [], {}
    for i in sorted(range(500), key=lambda k: -lengths[k]):
        b = next((k for k, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
        rooms += [100] * (b == len(rooms))
        want[i] = (b, 100 - rooms[b])
        rooms[b] -= lengths[i]
    assert {i: (bins[i], offsets[i]) for i in range(500)} == want


# ---- 7 secrets


def brute_spans(text):
    import re

    rules = [("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
             ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m)]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def test_secrets(spark, corpus, awkward, nothing):
    tricky = [(1, "token=abc secret=abcdefg PassWord : 'x+/y_.z=' api_key=\"0123456\""), (2, "😀😀 secret:token:abcdef apikey=zzzzzz" + "f" * 30 + "g" + "a" * 23), (3, "AKIA" + "Z" * 15 + " AKIAAKIA" + "Z9" * 12)]
    for frame, docs in ((corpus[0], [(i, t) for i, t, _ in corpus[2]]), (awkward, AWKWARD), (spark.createDataFrame(tricky, "doc_id long, text string"), tricky)):
        got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan_secrets(frame).collect())
        want = Counter()
        for i, text in docs:
            spans = brute_spans(text or "")
            kinds = Counter(s.split(":")[0] for s in spans)
            want[i, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
        assert got == want
    assert secrets.scan_secrets(nothing).count() == 0
    assert "forge:" in next(r.spans for r in secrets.scan_secrets(corpus[0].where("doc_id = 265")).collect())


def test_one_text_full_of_secrets(spark):
    text = " ".join(f"token=abcdef{k} {'ab' * 14}" for k in range(5000))
    row = secrets.scan_secrets(spark.createDataFrame([(1, text), (2, text), (None, text)], "doc_id long, text string")).collect()
    spans = brute_spans(text)
    assert {(r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in row} == {(5000, 0, 5000, hashlib.sha256(",".join(spans).encode()).hexdigest())} and len(row) == 3


def test_steps_scan_a_blob_once(spark):
    docs = spark.createDataFrame([(k, f"token=abcdef{k % 3}") for k in range(40)], "doc_id long, text string")
    ledger = secrets.BlobLedger(spark)
    first = sorted(map(tuple, secrets.scan_secrets(docs, ledger, steps=3).collect()))
    assert ledger.read().count() == 3 * len(secrets.PACKS)
    assert sorted(map(tuple, secrets.scan_secrets(docs, ledger).collect())) == first and ledger.read().count() == 3 * len(secrets.PACKS)


def test_ledger_scans_only_what_is_new(spark):
    ledger = secrets.BlobLedger(spark)
    first = spark.createDataFrame([("a", "token=abcdef1"), ("b", "token=abcdef1"), ("c", "none")], "path string, text string")
    ledger.update(first, (secrets.BASE,))
    assert ledger.read().count() == 2  # two blobs, one rule version
    paths = ledger.update(first.unionByName(spark.createDataFrame([("a", "token=abcdef2")], first.schema)), (secrets.BASE,))
    assert ledger.read().count() == 3
    assert Counter(len(r.findings) for r in ledger.findings(paths, (secrets.BASE,)).collect()) == {1: 3, 0: 1}
    ledger.update(first, secrets.PACKS)
    assert ledger.read().groupBy("rule_version").count().collect() and ledger.read().count() == 5


# ---- 8 language


def test_language_id(spark, corpus, awkward, nothing):
    frame, _, docs, _ = corpus
    model = langid.train(langid.learnable(frame))
    got = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in docs)
    held = [(i, lang) for i, _, lang in docs if got[i].held_out and i != 266]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert got[266].lang_pred == "und" and got[266].score == 0.0
    odd = langid.identify(awkward, model).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= r.score <= 1 for r in odd) and {r.lang_pred for r in odd if r.doc_id in (1, 2, 3)} == {"und"}
    empty = langid.train(nothing)
    assert {r.lang_pred for r in langid.identify(awkward, empty).collect()} == {"und"} and langid.identify(nothing, model).count() == 0
    accepted = langid.accepted(frame, model, 0.02)
    assert accepted.columns == frame.columns and accepted.count() == len(docs) - 1


def test_bundles_are_sums_of_bound_letters():
    a, b = langid.profile("ab", 64), langid.profile("AB", 64)
    assert (a == b).all() and langid.profile("12 !", 64) is None
    item = lambda c: np.random.default_rng(ord(c)).integers(0, 2, 64, dtype=np.int8) * 2 - 1
    bound = lambda x, y, z: np.roll(item(x), 2) * np.roll(item(y), 1) * item(z)
    total = (bound(" ", "a", "b") + bound("a", "b", " ")).astype(float)
    assert np.allclose(a, total / np.linalg.norm(total))


def test_marks_alone_are_no_letters():
    assert langid.profile("\u0301\u0301 1") is None and langid.profile("e\u0301") is not None


def test_prototypes_and_predictions_by_hand(spark, corpus):
    """Trigrams bound and bundled text by text in plain Python; prototypes, centring and cosines from those."""
    frame, _, docs, _ = corpus
    dims = 256
    item = lambda c: np.random.default_rng(ord(c)).integers(0, 2, dims, dtype=np.int8) * 2 - 1

    def vector(text):
        clean = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
        clean = " " + " ".join(clean.split()) + " " if clean.strip() else ""
        if text and clean and not text[0].isalpha():
            clean = " " + clean  # a leading blank is a letter of its own
        if text and clean and not text[-1].isalpha():
            clean += " "
        total = np.zeros(dims)
        for tri, n in Counter(clean[k : k + 3] for k in range(len(clean) - 2)).items():
            total += np.sqrt(n) * np.roll(item(tri[0]), 2) * np.roll(item(tri[1]), 1) * item(tri[2])
        return total / np.linalg.norm(total) if clean else None

    vectors = {i: vector(t) for i, t, _ in docs}
    langs = sorted({lang for _, _, lang in docs})
    learnt = [(i, lang) for i, _, lang in docs if zlib.crc32(str(i).encode()) % 4 != 2 and vectors[i] is not None]
    sums = np.array([sum(vectors[i] for i, lang in learnt if lang == name) for name in langs])
    unit = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    common = unit.mean(axis=0)
    centred = (unit - common) / np.linalg.norm(unit - common, axis=1, keepdims=True)
    model = langid.train(langid.learnable(frame).repartition(5), dimensions=dims)
    assert model.langs == langs and np.allclose(model.unit, centred, atol=1e-5)
    for r in langid.identify(frame, model).collect():
        if vectors[r.doc_id] is None:
            assert r.lang_pred == "und"
            continue
        v = vectors[r.doc_id] - common
        cosines = centred @ v / np.linalg.norm(v)
        assert r.lang_pred == langs[int(cosines.argmax())] and r.score == pytest.approx(max(0.0, cosines.max()), abs=1e-4)


# ---- 9 quality


def brute_kneser_ney(train, texts, size):
    split = lambda t: t.lower().replace(".", " ").replace(",", " ").split()
    counts = Counter(w for t in train for w in split(t))
    by_hash = {w: int(kneser_ney.words_of(w)[0]) for w in counts}
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    vocab = set(sorted(counts, key=lambda w: (-counts[w], signed(by_hash[w])))[:size])
    known = lambda w: w if w in vocab else "<unk>"
    pairs = Counter(p for t in train if (ws := [known(w) for w in split(t)]) for p in zip(["<s>", *ws], ws))
    d = kneser_ney.discounts({k: sum(1 for v in pairs.values() if v == k) for k in (1, 2, 3, 4)})
    cut = lambda n, ds: ds[min(n, 3) - 1] if n else 0.0
    before = Counter(b for _, b in pairs)
    words = ["<s>", "<unk>", *vocab]
    e = kneser_ney.discounts({k: sum(1 for w in words if before[w] == k) for k in (1, 2, 3, 4)})
    gamma = sum(cut(before[w], e) for w in words)
    share = 1 / (len(counts) - len(vocab) + 1)
    p1 = {w: (before[w] - cut(before[w], e) + gamma / (len(words) - 1)) / sum(before.values()) * (share if w == "<unk>" else 1) for w in words}
    mass = Counter()
    for (a, _), n in pairs.items():
        mass[a] += n
    out = {}
    for i, t in texts:
        ws = [known(w) for w in split(t or "")]
        total = 0.0
        for a, b in zip(["<s>", *ws], ws):
            back = sum(cut(n, d) for (x, _), n in pairs.items() if x == a) / mass[a] if mass[a] else 1.0
            main = (pairs[a, b] - cut(pairs[a, b], d)) / mass[a] * (share if b == "<unk>" else 1) if pairs[a, b] else 0.0
            total += np.log(main + back * p1[b])
        out[i] = (len(ws), total)
    return out


@pytest.mark.parametrize("shard_rows", [10, 1_000_000])
def test_kneser_ney(spark, corpus, monkeypatch, shard_rows):
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", shard_rows)
    docs = [(i, t) for i, t, _ in corpus[2]][:60] + [(900, ""), (901, None)]
    texts = [t for _, t in docs[:40]]
    trained = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"), 50)
    got = {r.doc_id: (r.n_words, r.logp) for r in kneser_ney.perplexities(spark.createDataFrame(docs, "doc_id long, text string"), trained).collect()}
    for i, (n, logp) in brute_kneser_ney(texts, docs, 50).items():
        assert got[i][0] == n and got[i][1] == pytest.approx(logp, abs=1e-4)


@pytest.mark.parametrize("vocabulary", [0, 50])
def test_words_beyond_the_vocabulary_are_no_unknown_word(spark, corpus, monkeypatch, vocabulary):
    """An open model is that of all words, however few have numbers."""
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", 500)
    docs = [(i, t) for i, t, _ in corpus[2]][:60] + [(900, ""), (901, None)]
    texts = [t for _, t in docs[:40]]
    trained = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"), vocabulary, open_vocabulary=True)
    got = {r.doc_id: (r.n_words, r.logp) for r in kneser_ney.perplexities(spark.createDataFrame(docs, "doc_id long, text string"), trained).collect()}
    for i, (n, logp) in brute_kneser_ney(texts, docs, 1_000_000).items():
        assert got[i][0] == n and got[i][1] == pytest.approx(logp, abs=1e-3)


@pytest.mark.parametrize("frequent", [0, 40, 1 << 20])
def test_common_bigrams_change_nothing(spark, corpus, monkeypatch, frequent):
    """However many corrections tasks hold, and wherever chunks end, scores are those of the whole model."""
    for name, value in (("SHARD_ROWS", 500), ("FREQUENT", frequent), ("SIFTED_KEYS", 200), ("CHUNK_KEYS", 300)):
        monkeypatch.setattr(kneser_ney, name, value)
    docs = [(i, t) for i, t, _ in corpus[2]][:60] + [(900, ""), (901, None), (None, corpus[2][0][1]), (None, "")]
    texts = [t for _, t in docs[:40]]
    trained = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"), 50, open_vocabulary=True)
    got = {r.doc_id: (r.n_words, r.logp) for r in kneser_ney.perplexities(spark.createDataFrame(docs, "doc_id long, text string"), trained).collect()}
    brute = brute_kneser_ney(texts, docs[:62], 1_000_000)
    assert len(got) == 63 and got[None] == pytest.approx(got[0])
    for i, (n, logp) in brute.items():
        assert got[i][0] == n and got[i][1] == pytest.approx(logp, abs=1e-3)


def test_common_bigrams_are_not_sent(spark):
    """The flow to the shards has less than a byte a word where all bigrams are common."""
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(i, " ".join(words[(i * k + k * k) % 40] for k in range(500))) for i in range(300)], "doc_id long, text string").coalesce(1)
    trained = kneser_ney.train(docs.select("text"), open_vocabulary=True)
    flow = trained.corrections.unionByName(docs.mapInArrow(kneser_ney._score_texts(spark.sparkContext.broadcast(trained.model)), kneser_ney._FLOW))
    assert sum(len(x) for r in flow.collect() for x in r if isinstance(x, (bytes, bytearray))) < 300 * 500


def test_finished_shuffles_leave_the_disk(spark):
    import time

    from maskwright.llm.scratch import materialise, shuffles_removed

    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    with shuffles_removed(spark):
        table = materialise(spark.range(10_000).selectExpr("id % 100 AS k").groupBy("k").count(), "counts")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and table.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_the_query_scores_with_all_words(spark, corpus):
    frame, _, docs, _ = corpus
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in docs if i % 2], "doc_id long, quality int, toxic int")
    few, all_words = ({r.doc_id: r.perplexity for r in kneser_ney.score_quality(frame, labels, vocabulary=v).collect()} for v in (5, 100_000))
    assert few == pytest.approx(all_words, rel=1e-4)


def test_quality(spark, corpus, awkward, nothing):
    frame, _, docs, _ = corpus
    junk = [(1000 + k, " | ".join(f"ZX{k}{m}!!" for m in range(60)), "en", "j", 1) for k in range(20)]
    frame = frame.unionByName(spark.createDataFrame(junk, frame.schema))
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in docs if i % 2] + [(1000, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.score_quality(frame, labels).collect()}
    assert len(got) == len(docs) + 20 and not any(got[1000 + k].keep for k in range(20))
    clean = [got[i].keep for i in range(220)]
    assert sum(clean) >= 0.9 * len(clean)
    odd = kneser_ney.score_quality(awkward, labels.limit(0)).collect()
    assert {(r.doc_id, r.keep) for r in odd if r.doc_id in (1, 2, 3)} == {(1, False), (2, False), (3, False)} and all(r.keep for r in odd if r.n_words)
    assert kneser_ney.score_quality(nothing, labels).count() == 0


def test_thresholds_by_hand(spark, corpus):
    """Costs, quantiles and their shrinkage from the perplexities; rows of a null id are scored whole."""
    frame, _, docs, _ = corpus
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in docs[:220]], "doc_id long, quality int, toxic int")
    odd = frame.unionByName(spark.createDataFrame([(None, docs[0][1], None, None, None)], frame.schema))
    got = {r.doc_id: r for r in kneser_ney.score_quality(odd, labels, quantile=0.9).collect()}
    assert got[None].perplexity == pytest.approx(got[0].perplexity) and got[None].lang == "und" and len(got) == len(docs) + 1
    held = {r.doc_id for r in spark.range(220).where("pmod(xxhash64(id), 10) = 0").withColumnRenamed("id", "doc_id").collect()}
    logp = {i: -r.n_words * np.log(r.perplexity) for i, r in got.items() if r.n_words}
    mean = -sum(logp[i] for i in held) / sum(got[i].n_words for i in held)
    cost = {i: (-logp[i] + 20 * mean) / (got[i].n_words + 20) for i in logp}
    quantile = lambda ids: sorted(cost[i] for i in ids)[int(np.ceil(0.9 * len(ids))) - 1]
    for i, r in got.items():
        own = [k for k in held if got[k].lang == r.lang]
        want = ((len(own) * quantile(own) if own else 0) + 30 * quantile(held)) / (len(own) + 30)
        assert r.threshold == pytest.approx(want, rel=1e-5)
        if r.n_words:
            assert r.score == pytest.approx(cost[i]) and r.keep == (r.score <= r.threshold)


# ---- 10 decontamination


def brute_align(a, b):
    best = 0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            new[j] = max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[j - 1] - 1)
            best = max(best, new[j])
        row = new
    return best


def test_alignment():
    rng = np.random.default_rng(5)
    for _ in range(100):
        a, b = (rng.integers(0, 4, rng.integers(1, 20)).astype(np.uint64) for _ in range(2))
        score, start, end = decontaminate.align(a, b)
        assert score == brute_align(a.tolist(), b.tolist())
        assert brute_align(a.tolist(), b[start:end].tolist()) == score  # the stretch alone has it
        if score:
            assert b[start] in a and b[end - 1] in a  # an alignment begins and ends with a word of the item


def test_where_a_passage_starts():
    item = decontaminate.item_words("one two three four five six seven eight")
    text = decontaminate.item_words("x y one two three new words four five six seven eight z")
    found = list(decontaminate.passages(text, decontaminate.Seeds([(5, "one two three four five six seven eight")]), 0.5))
    assert found == [(0, 14 / 16, 2, 12)] and len(item) == 8


def test_decontamination(spark, corpus, awkward, nothing):
    import re

    frame, bench, docs, item = corpus
    for block in (8 << 20, 10):
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame, bench, block_bytes=block).collect()}
        split = lambda t: re.findall(r"[^\W_]+", t.lower())
        want = {(i, 0): brute_align(split(item), split(t)) / 2 / len(split(item)) for i, t, _ in docs}
        want = {k: v for k, v in want.items() if v >= 0.5}
        assert got == pytest.approx(want) and {262, 263, 264} <= {i for i, _ in got}
    assert decontaminate.contaminated(nothing, bench).count() == 0 and decontaminate.contaminated(frame, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(awkward, bench).count() == 0
    assert {r.doc_id for r in decontaminate.contaminated(awkward, spark.createDataFrame([(1, "ONE!")], "item_id long, text string")).collect()} == {4, 5, 6}


def test_an_edited_passage_in_hundreds_of_documents(spark):
    """Common seeds stay seeds: an edited copy that many documents have, and one stretched by inserted words."""
    import random

    rnd = random.Random(11)
    item = [f"i{k}" for k in range(40)]
    edited = list(item)
    for k in (5, 15, 25, 35):
        edited[k] = f"other{k}"
    stretched = [w for k, w in enumerate(item[:20]) for w in ([w] if k < 3 else [w, f"new{k}"])] + item[20:]
    filler = lambda n: [f"f{rnd.randrange(500)}" for _ in range(n)]
    docs = [(d, [*filler(30), *(edited if d % 2 else stretched), *filler(30)]) for d in range(300)] + [(d, filler(90)) for d in range(300, 320)]
    docs.append((320, [*item[:3], *filler(60)]))  # three words of it are no passage
    frame = spark.createDataFrame([(d, " ".join(ws)) for d, ws in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "not there at all " + " ".join(item[:6])), (2, " ".join(item[:3]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame, bench).collect()}
    split = {i: t.split() for i, t in ((r.item_id, r.text) for r in bench.collect())}
    want = {(d, i): brute_align(ws, text) / 2 / len(ws) for d, text in docs for i, ws in split.items()}
    assert got == pytest.approx({k: v for k, v in want.items() if v >= 0.5})
    assert {d for d, i in got if i == 0} == set(range(300))


def test_windows_in_small_portions(monkeypatch):
    rng = np.random.default_rng(12)
    monkeypatch.setattr(decontaminate, "_WINDOWS", 3)
    for _ in range(150):
        items = [(k, " ".join(f"w{x}" for x in rng.integers(0, 6, rng.integers(1, 12)))) for k in range(4)]
        text = " ".join(f"w{x}" for x in rng.integers(0, 9, rng.integers(1, 60)))
        seeds, words = decontaminate.Seeds(items), decontaminate.item_words(text)
        got = {k: score for k, score, _, _ in decontaminate.passages(words, seeds, 0.5)}
        for k, item in items:
            a, b = item.split(), text.split()
            best = brute_align(a, b) / 2 / len(a)
            assert k not in got or 0.5 <= got[k] <= best
            if f" {item} " in f" {text} ":
                assert got[k] == 1.0


# ---- components


def test_connected_components(spark):
    import random

    from maskwright.llm.components import connected_components

    rnd = random.Random(6)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)] + [(5, 5)]
    group = {v: v for e in links for v in e}
    for _ in range(400):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert got == {v: group[v] for v in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
