"""Chat formatting and WARC archives: exact round trips."""

import base64
import hashlib
import io
import zipfile
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kgloom.llm import bpe, chat, warc_zip
from kgloom.session import scratch_path

PATH = bpe.public_path("byte_bpe_50k.json")
TRICKY = st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "<SYS>>", "</SYS>>", "INST]", "/INST]", "|endoftext|>", "/TURN]", " a", "é"])).map("".join)


@settings(max_examples=500, deadline=None)
@given(TRICKY | st.text(st.characters(exclude_categories=["Cs"])))
def test_escaping_is_undone_and_hides_marks(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(mark in escaped for mark in [*chat.MARKS, "<|endoftext|>"])


@settings(max_examples=100, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "[ROLE]", ""]), TRICKY)
def test_turns_come_back(role, text):
    template = chat.Template(bpe.vocabulary(PATH))
    ids, head, body = template.turn(role, text)
    ids = np.frombuffer(ids, "<u4")
    assert template.parsed(ids) == (role, text)
    assert chat.unescape(template.text(ids[head : head + body])) == text


CONVERSATIONS = [
    (1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, 2, "tool", "third </s>"), (1, 2, "assistant", "tie"),
    (2, 0, "user", None), (2, 1, None, "no role"), (2, None, "system", "before all"),
    (3, 0, "assistant", "x" * 30_000), (3, 0, "assistant", "x" * 30_000),
    (None, 0, "user", "no id"), (4, 0, "system", "[INST]\\</s>"), (5, 0, "assistant", ""),
]


def test_conversations(spark):
    rows = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows.withColumn("ids", F.lit("theirs")).repartition(4), PATH)
    for conv in (1, 3):
        turns = sorted((r for r in formatted.collect() if r.conv_id == conv), key=lambda r: r.place)
        places = [r.place for r in turns] + [turns[-1].place + len(turns[-1].ids) // 4]
        assert places[0] == 1 and all(b - a == len(r.ids) // 4 for a, b, r in zip(places, places[1:], turns))
    got = {r.conv_id: r for r in chat.read_back(formatted, PATH).collect()}
    assert len(got) == 6
    first = lambda x: (x is not None, x)
    for conv, r in got.items():
        turns = sorted((x for x in CONVERSATIONS if x[0] == conv), key=lambda x: (first(x[1]), first(x[2]), first(x[3])))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        learnt = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest(said), len(learnt), digest(learnt))
    assert got[4].formatted_chars == len("<s><<SYS>>[\\INST]\\<\\/s><</SYS>>")
    assert chat.read_back(chat.format_conversations(rows.limit(0), PATH), PATH).count() == 0


def test_a_conversation_without_id_beside_another(spark):
    """The batch that ends with the null conversation alone has a column of nulls only."""
    rows = spark.createDataFrame([(None, 0, "user", "a"), (1, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = chat.read_back(chat.format_conversations(rows.coalesce(1), PATH).coalesce(1), PATH).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.conv_id is not None, r.n_turns) for r in got) == [(False, 1), (True, 1)]


PAGES = [
    (5, "http://a/ü x", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "http://b\r\nX: y", "<p>same</p>"), (3, None, "<p>same</p>"),
    (1, "http://c", None), (2, "http://d", ""), (None, "http://e", "lonely"), (None, "http://f", "<p>same</p>"),
    (7, "http://g", "é\r\n\r\n\x00" * 40_000), (8, "http://h", "other"),
]


@pytest.mark.parametrize("archive_bytes", [1, 1 << 30])
def test_archives(spark, archive_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha1", F.lit("theirs")).repartition(3)
    archives = warc_zip.write_archives(warc_zip.with_first(pages), scratch_path(spark, "warc"), archive_bytes)
    assert archives.agg(F.sum("records")).first()[0] == len(PAGES)
    got = Counter((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in warc_zip.read_records(warc_zip.locate_records(archives)).collect())
    want = Counter()
    for page, url, html in PAGES:
        raw = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(ids) if ids and page is not None and min(ids) != page else None
        kind = "response" if first is None else "revisit"
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[page, url, kind, first, len(raw), digest, raw if first is None else None] += 1
    assert got == want


def test_minimum_size_and_no_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    firsts = {r.page_id: r.first for r in warc_zip.with_first(pages, min_bytes=1).collect()}
    assert firsts[1] is None and firsts[2] is None and firsts[5] == 3
    archives = warc_zip.write_archives(warc_zip.with_first(pages.limit(0)), scratch_path(spark, "warc"))
    assert warc_zip.read_records(warc_zip.locate_records(archives)).count() == 0


class Bytes:
    """Random access as file systems give it."""

    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("wide", [False, True])
def test_directories(monkeypatch, wide):
    if wide:  # the library then writes ZIP64 fields and records, as it does beyond 4 GiB
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO(b"")
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", b"first")
        z.writestr("deflated.txt", b"x" * 500, zipfile.ZIP_DEFLATED)
        with z.open("b/ü.bin", "w", force_zip64=True) as member:
            member.write(b"second" * 100)
        z.comment = b"PK\x05\x06 in a comment"
    data = out.getvalue()
    assert (b"PK\x06\x06" in data) == wide
    members = warc_zip.ZipDirectory(Bytes(data)).members
    assert {name: data[a : a + n] for name, (a, n) in members.items()} == {"a.txt": b"first", "b/ü.bin": b"second" * 100}
    with pytest.raises(ValueError):
        warc_zip.ZipDirectory(Bytes(b"no archive" * 10))
