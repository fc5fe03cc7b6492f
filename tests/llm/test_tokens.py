import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from slotline.llm import packing, token_files
from slotline.llm.token_ids import Encoder

ODD = [
    "", " ", "  a", "a  b \n\n c ", "é'S don't  ÉÀ ñ\t x y", "a\nb\n", "\n\na", " a", "a ", "Σας ΟΔΟΣ ΟΔΟΣ", "é ́x",
    "<|endoftext|> a<|startoftext|>b", "日本語 テスト123 45", "x\x1cy \x85z", "a\r\nb\rc", "👍🏽 ok!!  ...", "a.", ".",
    "a., b,. c.\nd,", "x" * 25 + ". " + "y" * 24, "a\xa0b \xa0 c", "a  b", "\n", "a\n b", "a \nb", "3.5. 4,", "\0a \0",
]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind, path", [("words", token_files.VOCABULARY), ("bytes", packing.VOCABULARY)])
def test_ids_are_the_library_s(kind, path, prose):
    encode, encoder = library(path), Encoder.of(kind, path)
    texts = [*ODD, *[prose(i, 50) for i in range(5)], *[a + b for a in ODD[:9] for b in ODD[:9]]]
    for _ in range(2):
        values, bounds = encoder.ids(texts)
        for at, text in enumerate(texts):
            assert values[bounds[at] : bounds[at + 1]].tolist() == encode(text), text


def test_a_full_word_table_starts_anew(prose):
    from slotline.llm.token_ids import WordTable

    encode, encoder = library(token_files.VOCABULARY), Encoder.of("words", token_files.VOCABULARY)
    whole, encoder.table = encoder.table, WordTable(64)
    try:
        for i in range(6):
            text = prose(i, 12)
            assert encoder.ids([text])[0].tolist() == encode(text)
    finally:
        encoder.table = whole


@pytest.mark.parametrize("kind, path", [("words", token_files.VOCABULARY), ("bytes", packing.VOCABULARY)])
def test_a_batch_of_more_words_than_the_table_has_slots(kind, path):
    import signal

    from slotline.llm.token_ids import WordTable

    def stop(*_):
        raise TimeoutError("the search for a free slot doesn't end")

    encode, encoder = library(path), Encoder.of(kind, path)
    whole, encoder.table = encoder.table, WordTable(64)
    before = signal.signal(signal.SIGALRM, stop)
    signal.alarm(30)
    try:
        for start in (0, 20, 500):
            texts = [" ".join(f"id{start + i}" for i in range(300)), " ".join(f"id{start + i % 90}" for i in range(200)), "x" * 30]
            values, bounds = encoder.ids(texts)
            for at, text in enumerate(texts):
                assert values[bounds[at] : bounds[at + 1]].tolist() == encode(text)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)
        encoder.table = whole


@pytest.mark.parametrize("ids_encoding", ["dictionary", "delta"])
def test_files_in_order_and_back(spark, make_documents, odd_rows, tmp_path, ids_encoding):
    path = str(tmp_path / "files")
    token_files.write(token_files.encoded(make_documents(*reversed(odd_rows))), path, ids_encoding, page_rows=100)
    encode, start = library(token_files.VOCABULARY), 0
    expected = sorted(([*encode(t), 2] for _, t in odd_rows), key=len)
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert sorted((r["ids"] for r in rows), key=len) == expected or sorted(map(tuple, (r["ids"] for r in rows))) == sorted(map(tuple, expected))
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    for row in rows:
        assert row["start"] == start and row["n_tokens"] == len(row["ids"])
        start += row["n_tokens"]
    for row in token_files.with_crc(token_files.read(spark, path)).collect():
        ids = next(r["ids"] for r in rows if r["start"] == row["start"])
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    # Encodings and page indexes as asked for.
    for file in (tmp_path / "files").glob("part-*"):
        group = pq.ParquetFile(file).metadata
        for at in range(group.num_row_groups):
            columns = {group.row_group(at).column(c).path_in_schema: group.row_group(at).column(c) for c in range(4)}
            ids = next(c for name, c in columns.items() if name.startswith("ids"))
            assert ids.has_offset_index and ids.has_column_index
            assert any("DICT" in x for x in ids.encodings) == (ids_encoding == "dictionary")
            assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings


def test_metadata_is_read_without_ids(spark, make_documents, odd_rows, tmp_path):
    token_files.write(token_files.encoded(make_documents(*odd_rows)), str(tmp_path / "f"))
    plan = token_files.read(spark, str(tmp_path / "f")).select("doc_id", "start")
    assert "ids" not in plan._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]


def test_no_documents(make_documents):
    assert token_files.round_trip(make_documents()).count() == 0
    assert packing.packed(make_documents()).count() == 0


def check_packing(rows, texts, window=packing.WINDOW):
    """Every id in one piece, sequences gapless and not too long; returns the share that is filled."""
    encode, by_document, by_sequence = library(packing.VOCABULARY), {}, {}
    for row in rows:
        by_document.setdefault(row["doc_id"], []).append(row)
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    for doc_id, text in texts.items():
        pieces = sorted(by_document[doc_id], key=lambda r: r["start"])
        ids = [*encode(text), packing.END_ID]
        assert [x for r in pieces for x in np.frombuffer(r["ids"], "<u4").tolist()] == ids
        assert [r["start"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces[:-1]]]).tolist()
        assert {r["doc_tokens"] for r in pieces} == {len(ids)}
    for pieces in by_sequence.values():
        at = 0
        for row in sorted(pieces, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(r["length"] for r in rows) / (window * len(by_sequence))


def test_packed_documents(make_documents, prose):
    texts = {i: prose(i, 5 + i * 37 % 900) for i in range(300)} | {1000: prose(7, 9000), 1001: None, 1002: ""}
    assert check_packing(packing.packed(make_documents(*texts.items())).collect(), texts) > 0.97


def test_copies_of_one_length_are_cut_where_they_fill_nothing(make_documents, prose):
    texts = {i: prose(5, 300) for i in range(120)}
    assert check_packing(packing.packed(make_documents(*texts.items())).collect(), texts) > 0.97


def test_odd_rows_are_packed(make_documents, odd_rows):
    rows = packing.packed(make_documents(*odd_rows)).collect()
    encode = library(packing.VOCABULARY)
    assert sum(r["length"] for r in rows) == sum(len(encode(t)) + 1 for _, t in odd_rows)


def test_least_squares_is_the_best_without_negatives():
    random = np.random.default_rng(2)
    for _ in range(20):
        columns, target = random.random((6, 9)), random.random(6) * 5
        x = packing.least_squares(columns, target)
        slope = columns.T @ (target - columns @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 1e-9]).max(initial=0) < 1e-6


def test_recipes_use_every_piece_once():
    random = np.random.default_rng(4)
    for count in (0, 1, 7, 300, 5000):
        lengths = np.clip(random.lognormal(6, 1, count).astype(int), 1, 2048)
        histogram = np.bincount(lengths, minlength=2049)
        made, streamed = packing.recipes(histogram)
        used = np.zeros(2049, int)
        for recipe in made:
            assert sum(recipe.lengths) <= 2048
            np.add.at(used, list(recipe.lengths), recipe.count)
        assert (used + streamed == histogram).all()


def test_starts_follow_the_files_numbers(spark, tmp_path):
    """Beyond 99,999 files their names as text are in another order."""
    for number, ids in ((99_999, [5, 6]), (100_000, [7])):
        one = spark.createDataFrame([(number, len(ids), 0, ids)], token_files.SCHEMA).coalesce(1)
        token_files.write(one, str(tmp_path / str(number)))
        part = max((tmp_path / str(number)).glob("part-*.parquet"), key=lambda x: x.stat().st_size)
        (tmp_path / "files").mkdir(exist_ok=True)
        part.rename(tmp_path / "files" / f"part-{number:05d}-x.parquet")
    found = token_files.read(spark, str(tmp_path / "files")).collect()
    assert {row.doc_id: row.start for row in found} == {99_999: 0, 100_000: 2}
