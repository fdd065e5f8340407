"""SimHash by definition, for the tests."""

import numpy as np
import xxhash


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    """Smallest position that each position reaches."""
    values, label = np.array(prints, np.uint64), list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius).tolist():
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(values))]
