"""Language model, quality rules, archive, shards and packing."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from civicpanel.llm import katz, packing, quality_rules, shards, warc_archive
from tests.llm.conftest import same


def katz_by_hand(rows):
    texts = [(i, [w.decode() for w in (t or "").encode().lower().split()] + [None]) for i, t, *_ in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    uni, bi = Counter(), Counter()
    for i, t in texts:
        if not held(i):
            uni.update(t)
            bi.update(zip([None, *t[:-1]], t, strict=True))
    total, types = sum(uni.values()), len(uni)
    n = lambda c: [sum(v == r for v in c.values()) for r in range(1, katz.K + 2)]
    one, two = katz.discounts(n(uni)), katz.discounts(n(bi))
    cut = lambda c, d: (d[c] if c <= katz.K else 1) * c
    unknown = 1 - sum(cut(c, one) for c in uni.values()) / total
    p1 = lambda w: cut(uni[w], one) / total if uni[w] else unknown
    after = defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c
    out = []
    for i, t in texts:
        score = 0.0
        for h, w in zip([None, *t[:-1]], t, strict=True):
            own = after.get(h)
            if own is None:
                score += math.log10(p1(w))
                continue
            base = sum(own.values()) + (min(own.values()) > katz.K)
            p = lambda v, base=base: cut(v, two) / base
            weight = (1 - sum(p(v) for v in own.values())) / (1 - sum(p1(x) for x in own))
            score += math.log10(p(own[w]) if w in own else weight * p1(w))
            if w not in own:  # the weights normalise exactly
                assert abs(sum(p(v) for v in own.values()) + weight * (1 - sum(p1(x) for x in own)) - 1) < 1e-9
        plain = sum(math.log10((uni[w] + 1) / (total + types + 1)) for w in t)
        out.append((i, held(i), len(t), sum(uni[w] > 0 for w in t), total, plain, score))
    return out


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_katz_equals_a_model_by_hand(docs, corpus, monkeypatch, hot):
    """Also with nearly every history split into parts."""
    monkeypatch.setattr(katz, "HOT", hot)
    key = lambda r: (r[0] is not None, r[0] or 0, r[6])
    got = sorted((tuple(r) for r in katz.score_corpus(docs).collect()), key=key)
    want = sorted(katz_by_hand(corpus[0]), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-6, abs=1e-6)


def test_katz_edge_cases(clashing, docs, empty):
    assert katz.score_corpus(empty).count() == 0
    assert katz.score_corpus(clashing).count() == docs.count()
    only = docs.where("doc_id = 2 OR doc_id = 9")
    assert all(math.isfinite(r.score) for r in katz.score_corpus(only).collect())


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + d for k in range(len(words) - 2) if runs[tuple(words[k : k + 3])] > 1 for d in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeated, len(covered)


def test_quality_counts_and_base_rule(docs, clashing, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality_rules.judged(docs)
    for r in judged.collect():
        want = counts_by_hand(r.text)
        assert tuple(r[n] for n in names) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.judged(empty).count() == 0
    columns = ["doc_id", *names, "base_failed", "kept"]
    assert same(judged.select(columns), quality_rules.judged(clashing).select(columns))


def test_sketches_merge_and_thresholds_follow_the_group(frame):
    """One group is full of symbols by nature; only the odd text of the other is rejected."""
    plain = ["w" + " abcd" * 60 + f" {i} x{i}y z{i * 7}q" + " ".join(f"k{i}j{j}" for j in range(70)) for i in range(300)]
    rows = [(i, t, "en", "prose", 1) for i, t in enumerate(plain)]
    rows += [(1000 + i, t.replace("k", "| k"), "en", "tables", 1) for i, t in enumerate(plain)]
    rows += [(5000, plain[0].replace("k", "| k"), "en", "prose", 1)]
    df = frame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id: (r.kept, r.reasons) for r in quality_rules.judged(df).collect()}
    assert kept[1000][0] and kept[1][0] and kept[5000] == (False, ["high_symbols"])
    counts = quality_rules.counted(df)
    halves = [quality_rules.sketches(counts.where(f"doc_id % 2 = {k}")) for k in (0, 1)]
    merged = halves[0].union(halves[1]).groupBy("level", "lang", "source", "measure", "bucket").sum("docs")
    assert same(merged, quality_rules.sketches(counts))


def test_archive_round_trip(frame, spark, tmp_path):
    big = "<p>" + "ü" * 200
    pages = [(5, "http://a/5", big), (2, None, big), (9, "http://a/\r\nX: y", big), (1, "u", "short"), (3, "u", "short"),
             (4, "u", None), (6, "u", ""), (7, "u", "once" * 50), (7, "u", "once" * 50), (None, "u", big)]
    df = frame(pages, "page_id bigint, url string, html string")
    found = sorted((tuple(r) for r in warc_archive.archive_pages(df.selectExpr("*", "1 AS digest", "2 AS payload")).collect()), key=str)
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        ids = [j for j, _, h in pages if (h or "") == (html or "") and j is not None]
        revisit = len(data) >= 100 and i != min(ids)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(ids) if revisit else None))
    assert found == sorted(want, key=str)
    assert warc_archive.archive_pages(df.limit(0)).count() == 0
    folder = str(tmp_path / "archive")
    headers = warc_archive.page_headers(df)
    payloads = df.selectExpr("CAST(coalesce(html, '') AS binary) AS payload")
    warc_archive.write_archive(headers, payloads, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({h or "" for _, _, h in pages})
    records = warc_archive.read_archive(spark, folder).collect()
    given = Counter((bytes(r.header), r.digest) for r in headers.collect())
    assert Counter((bytes(r.header), r.digest) for r in records) == given
    assert all(bytes(r.record) == bytes(r.header) + bytes(r.payload) for r in records)
    assert all(b"\r\nX: y" not in bytes(r.header) for r in records)


def parsed(data):
    """The (header fields, block) of every record of a WARC file; anything but the format's bytes is refused."""
    records, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].split(b"\r\n")
        assert version == b"WARC/1.1"
        fields = dict(line.split(b": ", 1) for line in lines)
        assert len(fields) == len(lines) and {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields)
        size = int(fields[b"Content-Length"])
        block, at = data[end + 4 : end + 4 + size], end + 4 + size + 4
        assert len(block) == size and data[at - 4 : at] == b"\r\n\r\n"
        records.append((fields, block))
    return records


def test_the_archive_is_a_warc_file(frame, spark, tmp_path):
    big = "<p>\r\n\r\nWARC/1.1\r\n" + "ü" * 200
    pages = [(5, "http://a/5", big), (2, None, big), (9, "http://a/\r\nX: y", big), (1, "u", "short"), (1, "u", "other"), (4, "u", None),
             (7, "u", "once" * 50), (7, "u", "once" * 50), (None, "u", big), (None, "u", "short"), (None, "u", "short")]
    df = frame(pages, "page_id bigint, url string, html string")
    folder = str(tmp_path / "archive")
    warc_archive.write_archive(warc_archive.page_headers(df), df.selectExpr("CAST(coalesce(html, '') AS binary) AS payload"), folder)
    rows = warc_archive.read_archive(spark, folder).collect()
    records = parsed(b"".join(bytes(r.warc) for r in rows))
    assert len(records) == len(pages)
    ids = {f[b"WARC-Record-ID"]: (f, b) for f, b in records}
    assert len(ids) == len(pages)
    for (fields, block), row in zip(records, rows, strict=True):
        digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
        if fields[b"WARC-Type"] == b"revisit":
            assert block == b"" and fields[b"WARC-Profile"] == warc_archive.PROFILE.encode()
            other, payload = ids[fields[b"WARC-Refers-To"]]
            assert other[b"WARC-Type"] == b"response" and hashlib.sha256(payload).hexdigest() == digest
        else:
            assert hashlib.sha256(block).hexdigest() == digest and block == bytes(row.payload)
    assert sum(f[b"WARC-Type"] == b"revisit" for f, _ in records) == 3


def test_a_changed_payload_stops_the_job(frame, spark, tmp_path):
    folder = str(tmp_path / "archive")
    frame([("00", b"h")], "digest string, header binary").write.parquet(f"{folder}/headers")
    frame([("00", b"other")], "digest string, payload binary").write.parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="payload without its digest"):
        warc_archive.read_archive(spark, folder).collect()


@pytest.mark.parametrize("number", [1, 7, 40])
def test_shards_are_gapless_and_even(docs, clashing, empty, number):
    found = shards.shard_by_bytes(docs, number).toPandas()
    rows = docs.collect()
    assert sorted(found["size"]) == sorted(len((r.text or "").encode()) + 16 for r in rows)
    assert Counter(found.text_crc32) == Counter(zlib.crc32((r.text or "").encode()) for r in rows)
    sizes = found.groupby("shard")["size"].sum()
    mean, largest = found["size"].sum() / number, found["size"].max()
    assert all(abs(s - mean) <= largest for s in sizes) and set(found.shard) <= set(range(number))
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert shards.shard_by_bytes(empty).count() == 0
    assert shards.shard_by_bytes(clashing, number).count() == len(rows)


def test_shards_hold_with_one_text_everywhere(frame):
    df = frame([(i, "same " * 40, "en", "s", 1) for i in range(500)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = shards.shard_by_bytes(df, 10).toPandas()
    assert set(found.groupby("shard").size()) == {50}


def test_pieces_and_places(docs, corpus, clashing, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    capacity = 64
    found = packing.pack(docs, capacity=capacity).toPandas()
    want = Counter()
    for i, text, *_ in corpus[0]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % capacity + 1
        for k, at in enumerate([0, *range(first, len(ids), capacity)]):
            end = first if k == 0 else at + capacity
            want[(i, k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes()))] += 1
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found.itertuples())
    assert got == want
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert list(own.offset) == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= capacity
    assert found.sequence_id.nunique() <= 1.05 * found.length.sum() / capacity + 1
    assert packing.pack(empty).count() == 0 and packing.pack(clashing, capacity=capacity).count() == len(found)


def test_best_fit_and_the_tree(frame, monkeypatch):
    assert packing.best_fit([6, 5, 4, 4, 1], 10) == [[0, 2], [1, 3, 4]]
    monkeypatch.setattr(packing, "TASK_ITEMS", 30)
    sizes = [1 + (i * 37) % 100 for i in range(400)]
    placed = packing.place(frame(list(enumerate(sizes)), "item bigint, length bigint"), 100).toPandas()
    assert sorted(placed["item"]) == list(range(400))
    placed["length"] = [sizes[i] for i in placed["item"]]
    fills = placed.groupby("sequence_id")["length"].sum()
    assert fills.max() <= 100 and len(fills) <= 1.15 * sum(sizes) / 100  # tasks of 30 items
    stuck = packing.place(frame([(i, 60) for i in range(100)], "item bigint, length bigint"), 100)
    assert stuck.select("sequence_id").distinct().count() == 100


def test_tokens_do_not_depend_on_the_encoder(tmp_path):
    """A file that cannot use the fast encoder gives the same ids through the slow one."""
    import json

    path = public_tokenizers.path("byte_bpe_50k.json")
    spec = json.loads(open(path, encoding="utf-8").read())
    spec["model"]["dropout"] = None
    other = tmp_path / "other.json"
    spec["normalizer"] = {"type": "Sequence", "normalizers": []}
    other.write_text(json.dumps(spec), encoding="utf-8")
    library = Tokenizer.from_file(path)
    for text in ("", "Hello  world\n\n x's 123 éü ß — 🙂", "a" * 3000, "<|endoftext|> end", "a<|endoftext|>b", "<|endoftext|"):
        want = library.encode(text, add_special_tokens=False).ids
        assert list(packing.encoder(path)(text)) == list(packing.encoder(str(other))(text)) == want
    assert list(packing.encoder(path)("a<|endoftext|>b")) == [64, 50256, 65]
