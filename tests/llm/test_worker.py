import weakref

import public_tokenizers

from tidemark.llm.byte_bpe import codec
from tidemark.llm.compression_quality import _features
from tidemark.llm.worker import kept

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_tables_go_when_another_operator_begins():
    """A worker that scored quality after it encoded tokens kept the codec's tables, hundreds of MB, in all later stages."""
    coder = codec(PATH, public_tokenizers.PATTERN)
    assert codec(PATH, public_tokenizers.PATTERN) is coder
    held = weakref.ref(coder)
    del coder
    first = _features("one text and another", b"one text " * 9, b"another " * 9)
    assert held() is None
    pairs = kept("compression_quality")
    assert len(pairs) == 1 and _features("one text and another", b"one text " * 9, b"another " * 9) == first
    assert kept("compression_quality") is pairs and len(pairs) == 1
