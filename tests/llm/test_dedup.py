import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pledgewise.llm import decontaminate, linededup, media, simhash, substrings
from pledgewise.llm.components import components

from . import brute


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_line_dedup(docs, docs_df, empty_df):
    assert rows(linededup.dedup_lines(docs_df), "doc_id", "n_lines", "n_removed", "text") == sorted(brute.line_dedup_merged(docs), key=repr)
    assert linededup.dedup_lines(empty_df).count() == 0


def test_line_dedup_has_no_python(docs_df):
    plan = linededup.dedup_lines(docs_df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_simhash(docs, docs_df, empty_df):
    fps = [brute.fingerprint(t) for _, t in docs]
    want = sorted(zip([i for i, _ in docs], [f"{f:016x}" for f in fps], brute.components([(i, f) for (i, _), f in zip(docs, fps, strict=True)]), strict=True), key=repr)
    for limit in (48, 2):
        assert rows(simhash.near_duplicates(docs_df, point_limit=limit), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(empty_df).count() == 0


def test_simhash_links_by_flips(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(120):
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 3)):
            f ^= 1 << b
        fps.append(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute.components(list(enumerate(fps)))
    for limit in (48, 3):
        root = {r.node: r.root for r in components(simhash.links(df, limit)).collect()}
        got = [root.get(f, f) for f in signed]
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(2)
    fps = [rng.getrandbits(64) - (1 << 63) for _ in range(50)]
    got = [r.e for r in spark.createDataFrame([(f,) for f in fps], "fp long").select(simhash.embedding(F.col("fp")).alias("e")).collect()]
    for f, e in zip(fps, got, strict=True):
        assert [e >> 4 * k & 15 for k in range(16)] == [(f >> 4 * k & 15).bit_count() for k in range(16)]


def test_decontaminate(spark, docs, docs_df, empty_df):
    passage = docs[3][1].split("\n")[0]
    items = [(1, passage), (2, " ".join(passage.split()[5:20])), (3, "one"), (4, None), (5, "..."), (5, "one two"), (12, passage[20:200]), (2, "w1 w2 w3")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute.decontaminate(docs, items), key=repr)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(decontaminate.decontaminate(docs_df, bench), *columns) == want
    assert rows(decontaminate.decontaminate(docs_df, bench, block_windows=9), *columns) == want
    shared = [*items, *[(100 + i, passage) for i in range(30)]]  # windows of more items than travel with them
    many = spark.createDataFrame(shared, "item_id long, text string")
    want_many = sorted(brute.decontaminate(docs, shared), key=repr)
    assert rows(decontaminate.decontaminate(docs_df, many), *columns) == want_many
    assert rows(decontaminate.decontaminate(docs_df, many, block_windows=9, few=2), *columns) == want_many
    assert decontaminate.decontaminate(empty_df, bench).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs_df, bench.where("false")).collect()} == {0}


def test_ids_of_items_are_text(spark):
    text = " ".join(f"q{k}" for k in range(20))
    docs = spark.createDataFrame([(1, text), (2, "z " * 30)], "doc_id long, text string")
    items = spark.createDataFrame([("mmlu-10", text), ("mmlu-9", text), (None, text), (None, "z")], "item_id string, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert got[1].n_items == 2 and got[1].items_sha256 == brute.sha("mmlu-10,mmlu-9")
    assert (got[2].n_hit, got[2].n_items, got[2].items_sha256, got[2].contaminated) == (30, 0, brute.sha(""), True)


@pytest.mark.parametrize("window", [13, 5, 3])
def test_substrings(docs, docs_df, empty_df, window):
    out = substrings.digest_rows(substrings.dedup_substrings(docs_df, window))
    assert rows(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substrings(docs, window), key=repr)
    assert substrings.dedup_substrings(empty_df).count() == 0


def test_substrings_over_more_levels(docs, docs_df):
    out = substrings.digest_rows(substrings.dedup_substrings(docs_df, 13, 3))
    assert rows(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substrings(docs, 13), key=repr)


def test_substrings_without_repeats(spark):
    """The search ends at its first level; only the exact copy loses words."""
    texts = [" ".join(f"{a}{k}" for k in range(30)) for a in "abc"]
    docs = [*enumerate(texts), (7, texts[1]), (None, texts[2]), (9, None)]
    out = substrings.digest_rows(substrings.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")))
    assert rows(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substrings(docs), key=repr)


def test_levels():
    assert substrings.levels(13) == [7, 13] and substrings.levels(3) == [3] and substrings.levels(32, 4) == [4, 8, 16, 32]


def test_media(docs, docs_df, empty_df):
    got = {}
    for r in media.digest(docs_df).collect():
        assert got.setdefault(r.doc_id, r[1:]) == r[1:]
    for i, t in docs:
        raw = (t or "").encode()
        payload = raw.ljust(max(-(-len(raw) // 192), 1) * 192, b" ")
        r = got[i]
        assert r[:2] == (len(raw), len(payload)) and r[2] == hashlib.sha256(payload).hexdigest() and r[3] == zlib.crc32(payload[-16:])
    assert media.digest(empty_df).count() == 0
    assert media.clips(media.encode(docs_df)).where("end_s <= begin_s").count() == 0


def test_media_all_bytes_round_trip():
    payload = np.random.default_rng(1).integers(0, 256, (300, media.FRAME)).astype(np.uint8)
    payload[:9] = media.BIAS  # coefficients of zero: runs of every length
    payload[1, 63], payload[2, 1], payload[3, ::17], payload[4, ::40], payload[5, 64:66], payload[6] = 0, 255, 7, 9, 1, 255
    avi = media.write_avi(media.encode_bytes(payload))
    seconds, places = media.read_index(avi)
    found = media.decode_coefficients([avi[a : a + n] for a, n in places])
    assert seconds == 0.04 and (np.stack([c for _, c in found]).reshape(300, -1) + media.BIAS == payload).all()
    assert [f.shape for f in media.frames(avi)[1]] == [(media.HIGH, media.WIDE)] * 300


def plain_jpeg(blocks, steps, wide, high, restart):
    """A grey baseline JPEG written code by code, with tables, a comment and restart markers of its own."""
    symbols = [16 * run + size for run in range(16) for size in range(11)]
    counts = [0] * 7 + [len(symbols)] + [0] * 8
    codes = media.huffman_codes(counts, symbols)

    def write(symbol, value):
        code, n = codes[symbol]
        size = abs(value).bit_length()
        extra = value if value >= 0 else value + (1 << size) - 1
        return f"{code:0{n}b}" + (f"{extra:0{size}b}" if size else "")

    scan, bits, last = b"", "", 0
    for k, block in enumerate(blocks):
        if restart and k and k % restart == 0:
            bits += "1" * (-len(bits) % 8)
            scan += int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00") + bytes([0xFF, 0xD0 + (k // restart - 1) % 8])
            bits, last = "", 0
        bits += write(abs(block[0] - last).bit_length(), block[0] - last)
        last, run, end = block[0], 0, max((i for i in range(64) if block[i]), default=0)
        for i in range(1, end + 1):
            if block[i] == 0:
                run += 1
                continue
            while run > 15:
                bits, run = bits + write(0xF0, 0), run - 16
            bits, run = bits + write(16 * run + abs(block[i]).bit_length(), block[i]), 0
        bits += "" if end == 63 else write(0, 0)
    bits += "1" * (-len(bits) % 8)
    scan += int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00")
    part = media._segment
    head = part(0xE0, b"JFIF\x00") + part(0xFE, b"made by hand") + part(0xDB, b"\x03" + bytes(steps)) + part(0xC0, struct.pack(">BHHB", 8, high, wide, 1) + bytes([1, 0x11, 3]))
    head += part(0xC4, b"\x01" + bytes(counts) + bytes(symbols) + b"\x12" + bytes(counts) + bytes(symbols)) + (part(0xDD, struct.pack(">H", restart)) if restart else b"")
    return b"\xff\xd8" + head + part(0xDA, bytes([1, 1, 0x12, 0, 63, 0])) + scan + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 1, 2])
def test_any_grey_baseline_frame(restart):
    rng = random.Random(restart)
    wide, high, steps = 20, 13, [rng.randint(1, 9) for _ in range(64)]
    blocks = [[rng.randint(-90, 90) if i == 0 else rng.choice([0, 0, 0, 0, rng.randint(-20, 20)]) for i in range(64)] for _ in range(6)]
    blocks[1], blocks[2][1:] = [0] * 64, [0] * 62 + [3]
    order = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    want = np.zeros((16, 24))
    for k, block in enumerate(blocks):
        for y in range(8):
            for x in range(8):
                total = 0.0
                for i, (v, u) in enumerate(order):
                    scale = (math.sqrt(0.5) if u == 0 else 1) * (math.sqrt(0.5) if v == 0 else 1) / 4
                    total += scale * block[i] * steps[i] * math.cos((2 * x + 1) * u * math.pi / 16) * math.cos((2 * y + 1) * v * math.pi / 16)
                want[8 * (k // 3) + y, 8 * (k % 3) + x] = min(max(total + 128, 0), 255)
    (header, found), (_, own) = media.decode_coefficients([plain_jpeg(blocks, steps, wide, high, restart), media.encode_bytes(np.full((1, media.FRAME), 65))[0]])
    assert found.tolist() == blocks and (header.wide, header.high) == (wide, high) and (own == 65 - media.BIAS).all()
    assert np.abs(media.samples_of(header, found[None])[0] - want[:high, :wide]).max() <= 0.51


def test_media_refuses_other_files():
    with pytest.raises(ValueError):
        media.read_index(b"RIFX0000WAVE")
    colour = media._segment(0xC0, struct.pack(">BHHB", 8, 8, 8, 3) + bytes(9))
    with pytest.raises(ValueError):
        media.parse_header(colour)


def test_media_feature(spark):
    """The feature and the clips against a plain reading of the stored file."""
    text = "a quiet passage of plain words. " * 60 + "\x00\xff" * 700 + "ZZZZ" * 500
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    avi = {r.doc_id: r.avi for r in media.encode(docs).collect()}
    seconds, images = media.frames(bytes(avi[1]))
    shares = [np.bincount(i.ravel() >> 4, minlength=16) / i.size for i in images]
    change = [float(np.abs(b - a).sum()) for a, b in zip(shares, shares[1:], strict=False)]
    cuts = [0]
    for k, x in enumerate(change):
        past = np.array(change[max(k - 8, 0) : k] or [0.0])
        if x > max(past.mean() + 3 * past.std(), 0.5):
            cuts.append(k + 1)
    want = [(b - a, f"{np.mean([i.mean() for i in images[a:b]]):.3f}") for a, b in zip(cuts, [*cuts[1:], len(images)], strict=True)]
    got = {r.doc_id: r for r in media.digest(docs).collect()}
    assert len(cuts) > 2 and got[1].feature == f"{len(cuts)}:" + ",".join(f"{n}@{m}" for n, m in want) == got[2].feature
    assert got[1].media_sha256 == hashlib.sha256(avi[1]).hexdigest() and got[1].media_bytes == len(avi[1]) and got[3].n_bytes == 0
    rows = media.clips(media.encode(docs)).where("doc_id = 1").orderBy("clip").collect()
    assert [r.n_frames for r in rows] == [n for n, _ in want] and rows[0].end_s == pytest.approx(want[0][0] * seconds)


def test_shots():
    samples = np.concatenate([np.full((20, media.FRAME), 10), np.full((20, media.FRAME), 200), np.full((5, media.FRAME), 90)]).astype(np.uint8)
    assert media.shots(media.histograms(samples)) == [0, 20, 40]


def test_one_long_text(spark, monkeypatch):
    """Texts of more than a slice through the operators that look for what repeats."""
    own = [f"w{i % 70_001}" for i in range(260_000)]
    docs = [(2, " ".join(own)), (1, " ".join(own[1000:1040])), (3, "\n".join(own[:90_000])), (4, "\n".join(["x", *own[:4], "y"])), (5, "alone")]
    assert len(docs[0][1]) > 1.4 * (1 << 20)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(linededup.dedup_lines(df), "doc_id", "n_lines", "n_removed", "text") == sorted(brute.line_dedup_merged(docs), key=repr)
    out = substrings.digest_rows(substrings.dedup_substrings(df))
    assert rows(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substrings(docs), key=repr)
    items = [(1, docs[1][1]), (2, "w70000 w0 w1")]
    found = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    assert rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(brute.decontaminate(docs, items), key=repr)
    fps = [brute.fingerprint(t) for _, t in docs]
    want = sorted(zip([i for i, _ in docs], [f"{f:016x}" for f in fps], brute.components([(i, f) for (i, _), f in zip(docs, fps, strict=True)]), strict=True), key=repr)
    assert rows(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == want
    monkeypatch.setattr(media, "GROUP", 1000)  # the long text is stored and decoded in several groups
    for r in media.digest(df).collect():
        raw = dict(docs)[r.doc_id].encode()
        payload = raw + b" " * (-len(raw) % 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())


def test_substrings_past_the_limit_of_broadcasts_and_with_a_hot_id(spark, docs, docs_df, monkeypatch):
    hot = [(7, t) for _, t in docs[:60]] + [(3, docs[3][1])]
    many = spark.createDataFrame([*docs, *hot], "doc_id long, text string").repartition(4)
    want = sorted(brute.substrings([*docs, *hot]), key=repr)
    assert rows(substrings.digest_rows(substrings.dedup_substrings(many)), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    monkeypatch.setattr(substrings, "BROADCAST", 0)
    assert rows(substrings.digest_rows(substrings.dedup_substrings(many)), "doc_id", "n_words", "n_removed", "kept_sha256") == want
