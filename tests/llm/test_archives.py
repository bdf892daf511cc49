"""WARC archives and token shards: exact round trips."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orthoweave.llm import token_output, warc
from orthoweave.session import work_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, "http://a/ü\r\nX: y", "<p>ü</p>"), (4, None, None),
    (5, "http://a/5", ""), (None, "http://a/n", "<p>x</p>"), (None, "http://a/m", "only\r\n\r\nnull"), (7, "http://b", "z" * 300_000),
    (8, "http://c", "twice"), (8, "http://c", "twice"), (0, "http://0", "z" * 300_000)]


def expected(pages, least=0):
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        to = first.get(h or "")
        again = i != to and len(data) >= least
        out.append((i, len(data), b32(data), "revisit" if again else "response", to if again else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 6])
def test_archive_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' AS digest", "'y' AS payload", "'z' AS response", "1 AS offset")
    rows = warc.archive_round_trip(pages, least).collect()
    assert Counter(map(tuple, rows)) == expected(PAGES, least)


def test_selected_payloads(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    index = warc.write_archives(pages)
    rows = warc.read_records(index.where("page_id in (0, 3, 7)")).collect()
    assert {r.page_id: r.payload and bytes(r.payload) for r in rows} == {0: b"z" * 300_000, 3: "<p>ü</p>".encode(), 7: None}


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_ranges_merge():
    far = warc.GAP + 200
    parts = list(warc.merged([("a", 0, 10), ("a", 10, 90), ("a", far, 5), ("b", 0, 7), ("b", 7, warc.READ_BYTES)]))
    assert parts == [("a", 0, [(0, 10), (10, 90)]), ("a", far, [(far, 5)]), ("b", 0, [(0, 7)]), ("b", 7, [(7, warc.READ_BYTES)])]


def test_damaged_record_is_refused():
    record = bytearray(zlib.decompress(warc.build_record(1, "http://a", b"payload", 1, False), 31))
    record[-8] ^= 1
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        warc.parse_record(packer.compress(bytes(record)) + packer.flush())


def plain_tokens(docs):
    """Ids of each row, in order of id (nulls first) and text."""
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


@pytest.mark.parametrize("table", ["awkward", "clashing", "empty"])
def test_token_round_trip(table, request):
    docs = request.getfixturevalue(table)
    assert Counter(map(tuple, token_output.token_digest(docs, PATH).collect())) == plain_tokens(docs)


def test_unknown_ids_give_no_row(spark, awkward):
    manifest = token_output.write_shards(awkward, PATH, work_dir(spark, "tokens"))
    keys = spark.createDataFrame([(12345, 1), (-5, 1), (7, 1), (7, 1)], "doc_id long, copies long")
    assert {r.doc_id for r in token_output.read_documents(manifest, keys).collect()} == {7}


def test_word_cuts_keep_tokens():
    encoder, tokenizer = token_output.Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "a\t b", "it's 's 12 3x", "a  b", "a  b", "x\x1c y",
             "a\x85 b", "ü  ß\r\n c", "don't  stop", "a <|endoftext|> b", "!! ?  . ,x", "\n\n a \n\n", "日本 語 x"]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_of_letters_skip_the_cut(monkeypatch):
    encoder, tokenizer = token_output.Encoder(PATH), Tokenizer.from_file(PATH)
    lines = []
    monkeypatch.setattr(encoder, "_encode_lines", lambda words, blank, plain=encoder._encode_lines: (
        lines.extend(words), plain(words, blank))[1])
    texts = ["The theaon ofouedti, Ndwhed's nai\u0308ve na\u00efve x2 ABC\nabc Zz. \u0120a \u00c9paie\u00e7\u0142", "The", "", "a  b\n c"]
    found = encoder.encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(set(lines)) == ["Ndwhed's", "nai\u0308ve", "x2"]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_perfect_hash(n):
    keys = token_output.hash_keys(np.arange(n) * 7 - 3, np.zeros(n, bool), np.zeros(n, np.int64))
    numbers = token_output.PerfectHash.build(keys).numbers(keys)
    assert sorted(numbers.tolist()) == list(range(n))
    index = token_output.ShardIndex.build(keys, np.arange(n) * 5, np.arange(n) % 9, 2)
    again = token_output.ShardIndex.unpack(index.pack())
    slots = again.find(keys)
    assert (again.starts[slots] == np.arange(n) * 5).all() and (again.counts[slots] == np.arange(n) % 9).all()
    strange = token_output.hash_keys(np.arange(1000) + 10**9, np.zeros(1000, bool), np.zeros(1000, np.int64))
    assert (again.find(strange) >= 0).sum() <= 1
