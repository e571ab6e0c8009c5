"""Large JSON documents cut into blocks."""

import gzip
import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crowdspark.sources import json_entries, readers

TEXT = st.text(st.sampled_from('ab"\\{}[],: é\n\x7f'), max_size=8)
VALUES = st.recursive(st.none() | st.booleans() | st.integers() | TEXT,
                      lambda v: st.lists(v, max_size=4) | st.dictionaries(TEXT, v, max_size=4), max_leaves=12)


def states(data: bytes, block: int):
    """Blocks of a document with the state at their beginnings."""
    file, parity, depth = pa.BufferReader(data), 0, 0
    for start in range(0, len(data), block):
        stop = min(start + block, len(data))
        yield file, start, stop, parity, depth
        quotes, *deeper = json_entries._summary(file, start, stop)
        parity, depth = parity ^ quotes, depth + deeper[parity]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(TEXT, VALUES, max_size=6), st.integers(1, 40), st.booleans(), st.integers(1, 50))
def test_entries_of_any_document_in_any_blocks(document, block, ascii_only, piece):
    data = json.dumps(document, ensure_ascii=ascii_only, indent=2 if block % 2 else None).encode()
    old, json_entries.PIECE = json_entries.PIECE, piece
    try:
        got = {}
        for state in states(data, block):
            for _, _, entry in json_entries._entries(*state, 1):
                if entry.strip():
                    got.update(json.loads(b"{" + entry + b"}"))
    finally:
        json_entries.PIECE = old
    assert got == document


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(TEXT, st.lists(VALUES, max_size=5), max_size=4), st.integers(1, 40))
def test_elements_of_any_arrays_in_any_blocks(document, block):
    data = json.dumps(document).encode()
    got, opened = {name: [] for name in document}, None
    for file, start, stop, parity, depth in states(data, block):
        name = None if opened is None else json_entries._key_before(file, opened)
        for first, place, entry in json_entries._entries(file, start, stop, parity, depth, 2):
            name = json_entries._key_before(file, place) if first else name
            if entry.strip():
                got[name].append(json.loads(entry))
        found = json_entries._last_array(file, start, stop, parity, depth)
        opened = opened if found is None else found
    assert got == document


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_documents_are_read_by_many_tasks(spark, tmp_path, block):
    document = {f"c{i}": {"a": 'x"\\{,' * (i % 5), "n": [i, {"k": "}"}]} for i in range(200)}
    (tmp_path / "a.json").write_text(json.dumps(document))
    (tmp_path / "b.json").write_text(json.dumps({"other": {"a": "é", "n": []}}, ensure_ascii=False))
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(json.dumps({"packed": {"a": "", "n": None}}).encode()))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" { }\n")
    got = {}
    for row in json_entries.object_entries(spark, str(tmp_path), block).collect():
        got.update(json.loads(row["value"]))
    assert got == {**document, "other": {"a": "é", "n": []}, "packed": {"a": "", "n": None}}


def test_a_broken_entry_harms_no_other(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"a": {"aggregated_pred": {}}, "b": nonsense, "c": {"aggregated_pred": {}}, "d": {"agg')
    rows = readers.read_predictions(spark, str(tmp_path)).where("prediction IS NOT NULL")
    assert sorted(r["capture_id"] for r in rows.collect()) == ["a", "c"]


def test_label_files_in_small_blocks(spark, tmp_path):
    document = {"info": {"year": 2020, "notes": ["x"]}, "categories": [{"id": i, "name": f"n{i}"} for i in range(3)],
                "licenses": [{"id": 9, "name": "no category"}], "images": [], "annotations": [{"image_id": "a]", "category_id": 1}]}
    (tmp_path / "l.json").write_text(json.dumps(document))
    got = [tuple(r) for r in json_entries.array_entries(spark, str(tmp_path), 11).collect()]
    by_name = {n: sorted(v.strip() for m, v in got if m == n) for n in document}
    assert by_name["categories"] == sorted(json.dumps(c) for c in document["categories"])
    assert by_name["licenses"] == [json.dumps(document["licenses"][0])] and by_name["images"] == []
    assert by_name["annotations"] == [json.dumps(document["annotations"][0])]


def test_images_of_a_label_file_are_not_broadcast(rows):
    """Tables read in blocks look as small as their list of blocks; only the closed list of labels may be broadcast."""
    found = readers.labelled_images(
        rows("id name", [("c", "lion")]), rows("id file_name seq_id season location datetime", [("1", "f", "s", "S", "x", None)]),
        rows("image_id category_id", [("1", "c")]))
    assert found._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 1
    assert [tuple(r) for r in found.collect()] == [("f", "s", "S", "x", "", "lion")]


def test_entries_of_several_written_documents(spark, rows, tmp_path):
    from crowdspark.plans import load_all
    load_all()
    from crowdspark.plans.source_queries import write_document
    folder, numbers = str(tmp_path / "labels"), [(str(i),) for i in range(20)]
    write_document(['{"a": [', rows("value", numbers), '], "b": [', rows("value", numbers[:3]), "]}"], folder, document_rows=6)
    got = json_entries.array_entries(spark, folder, 16).collect()
    assert sorted((r.name, int(r.value)) for r in got) == [("a", i) for i in range(20)] + [("b", i) for i in range(3)]
    assert len(list((tmp_path / "labels").glob("document=*/*.txt"))) == 4
