"""Quality statistics of texts longer than one piece."""

import random
import zlib

from txlens.llm import quality


def compression(text):
    return quality.statistics(text)[quality.STATISTICS.index("compression")]


def test_compression_is_of_the_whole_text():
    rnd = random.Random(8)
    prose = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(160_000))
    junk = "buy now " * 150_000
    assert len(prose) > quality.PIECE
    for text in (prose, prose + junk, junk + prose, prose[:5000], "é" * 700_000):
        data = text.encode()
        assert compression(text) == len(zlib.compress(data, 1)) / len(data)
    assert compression(prose + junk) < 0.6 * compression(prose)
