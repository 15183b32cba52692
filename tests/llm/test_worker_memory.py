"""What a Python worker keeps between documents is bounded."""

from alloy.llm import linear, near_dup


def test_word_caches_stay_small():
    hashes, cells = near_dup.WordHashes(), linear.Cells(False)
    first = hashes[b"w0"], cells["w0"]
    for i in range(150_000):
        hashes[b"w%d" % i], cells[f"w{i}"]
        assert len(hashes) <= 100_000 and len(cells) <= 100_000
    assert first == (hashes[b"w0"], cells["w0"])
