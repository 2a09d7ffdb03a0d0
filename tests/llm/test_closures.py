"""Functions travel to the executors by value: what the driver has cached must not travel with them."""

import numpy as np
from pyspark import cloudpickle

from faremill.llm import decontam, texts


def test_a_filled_cache_stays_at_home():
    text = np.frombuffer(b"one two", np.uint8)
    before = texts.span_hashes(text, np.array([0, 4]), np.array([3, 7]))
    assert texts.POWERS
    sent = cloudpickle.dumps(decontam._document_words)
    assert len(sent) < 100_000
    assert len(cloudpickle.loads(sent).__globals__["span_hashes"].__globals__["POWERS"]) == 0
    assert cloudpickle.loads(cloudpickle.dumps(texts.span_hashes))(text, np.array([0, 4]), np.array([3, 7])).tolist() == before.tolist()
