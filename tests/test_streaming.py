"""Planned chunks of a file stream: none twice, also over restarts."""

import json

from foliospark.streaming.resume import plan_stream, read_chunk_stream

SCHEMA = "doc_id long, text_hash string, mode string, fingerprint string, chunk_index int"


def test_stream_resumes(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()

    def put(name, indices):
        (folder / name).write_text("\n".join(json.dumps({"doc_id": 1, "text_hash": "h", "mode": "m", "fingerprint": "f", "chunk_index": i}) for i in indices))

    def run():
        query = plan_stream(read_chunk_stream(spark, str(folder), SCHEMA, 1), str(tmp_path / "cache"), str(tmp_path / "check"), lambda df, _: seen.extend(r["chunk_index"] for r in df.collect()))
        assert query.awaitTermination(120)

    put("a.json", [1, 2, 2])
    run()
    put("b.json", [2, 3])
    run()
    assert sorted(seen) == [1, 2, 3]


def test_a_crash_while_handling_loses_nothing(spark, tmp_path):
    folder, seen, broken = tmp_path / "in", [], [True]
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps({"doc_id": 1, "text_hash": "h", "mode": "m", "fingerprint": "f", "chunk_index": i}) for i in (1, 2)))

    def handle(df, batch):
        if broken.pop() if broken else False:
            raise RuntimeError("lost")
        seen.extend((batch, r["chunk_index"]) for r in df.collect())

    for _ in range(2):
        query = plan_stream(read_chunk_stream(spark, str(folder), SCHEMA, 1), str(tmp_path / "cache"), str(tmp_path / "check"), handle)
        try:
            query.awaitTermination(120)
        except Exception as e:
            assert "lost" in str(e)
    assert sorted(seen) == [(0, 1), (0, 2)]


def test_keys_are_known_by_state_and_left_ones_come_again(spark, tmp_path):
    def put(folder, name, indices):
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(json.dumps({"doc_id": 1, "text_hash": "h", "mode": "m", "fingerprint": "f", "chunk_index": i}) for i in indices))

    for most, want in ((None, [[1, 2, 3], [4]]), (2, [[1, 2], [3, 4]])):
        folder, got = tmp_path / f"in{most}", []
        for n, indices in enumerate(([1, 2, 3], [3, 1, 4])):
            put(folder, f"{n}.json", indices)
            seen = []
            cache = tmp_path / f"cache{most}-{n if most is None else 0}"  # without a limit the second run doesn't see the first one's cache
            query = plan_stream(read_chunk_stream(spark, str(folder), SCHEMA, 1), str(cache), str(tmp_path / f"check{most}"), lambda df, _: seen.extend(r["chunk_index"] for r in df.collect()), most)
            assert query.awaitTermination(120)
            got.append(sorted(seen))
        assert got == want
