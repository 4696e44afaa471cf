import random
import tracemalloc

from linkweave.llm.name_links import NameCosine, near_words


def test_what_a_worker_keeps_of_names_is_bounded():
    """Executors share 3000 MB among the JVM and the workers of their cores; a worker's names may take a hundred."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(120_000)]
    tracemalloc.start()
    measure = NameCosine({}, 2.0)
    for a, b in zip(words[::2], words[1::2]):
        measure.words(a, b)
        near_words(a, b)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    near_words.cache_clear()
    assert held < 100e6
    assert len(measure.vectors) and len(measure.known)
