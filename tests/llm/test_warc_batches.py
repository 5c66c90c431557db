"""What tasks that write and read archives hold at once."""

import pyarrow as pa

from loanlens.llm import warc


def test_writers_and_readers_hand_over_a_few_pages_at_a_time(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_AT_ONCE", 4000)
    n, payload = 200, b"x" * 1500
    pages = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array(["u"] * n), pa.array([payload] * n), pa.array(["00" * 20] * n), pa.array([None] * n, pa.int64())],
        names=["page_id", "url", "payload", "payload_digest", "refers_to"],
    )
    digest = warc.hashlib.sha1(payload).hexdigest()
    pages = pages.set_column(3, "payload_digest", pa.array([digest] * n))
    index = list(warc._write(f"file://{tmp_path}")(iter([pages])))
    assert max(b.num_rows for b in index) <= warc.PAGES_AT_ONCE
    places = pa.Table.from_batches(index).select(["archive", "offset", "length"]).combine_chunks().to_batches()
    found = list(warc._read(f"file://{tmp_path}", True)(iter(places)))
    assert max(sum(map(len, b.column("payload").to_pylist())) for b in found) <= 4000 + len(payload)
    every = pa.Table.from_batches(found)
    assert every["page_id"].to_pylist() == list(range(n)) and set(every["payload"].to_pylist()) == {payload}
    bare = pa.Table.from_batches(list(warc._read(f"file://{tmp_path}", False)(iter(places))))
    assert bare["page_id"].to_pylist() == list(range(n))
