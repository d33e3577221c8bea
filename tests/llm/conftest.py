import string

import pytest


@pytest.fixture(scope="session")
def words():
    """Deterministic word maker: words(seed, n) gives n words."""
    import random

    def make(seed, n, vocabulary=400):
        r = random.Random(seed)
        listed = ["".join(random.Random(i).choices(string.ascii_lowercase, k=2 + i % 7)) for i in range(vocabulary)]
        return [r.choice(listed) for _ in range(n)]

    return make
