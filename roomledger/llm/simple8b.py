"""Simple-8b: as many ids in each 64-bit word as its 60 payload bits hold.

The top four bits of a word select one of ``COUNTS``; the ids follow from the
low bits up, 60 // count bits each. Selector ``ESCAPE`` says that the next word
is one id of up to 64 bits. Ids are coded in blocks of ``BLOCK`` that start at
words of their own, so that all blocks of a range are packed, and unpacked, in
the same array operations.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BITS = 60 // COUNTS
ESCAPE = 15
PAYLOAD = np.uint64((1 << 60) - 1)


def _compared_widths(values: np.ndarray) -> np.ndarray:
    widths = np.full(values.shape, 64, np.uint8)
    for bits in np.unique(BITS)[::-1]:
        widths[values < np.uint64(1 << int(bits))] = bits
    return widths


SMALL_WIDTHS = _compared_widths(np.arange(1 << 16, dtype=np.uint64))


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, by the next payload width; 64 beyond all of them. Ids of 16 bits are looked up."""
    if values.max(initial=0) < len(SMALL_WIDTHS):
        return SMALL_WIDTHS[values.astype(np.int64)]
    return _compared_widths(values)


def _fitting(values: np.ndarray) -> np.ndarray:
    """For every place of every block the selector that packs the most ids from there on."""
    most = _widths(values)
    fit = np.where(most <= 60, 0, ESCAPE).astype(np.uint8)
    before = 1
    for selector, count in enumerate(COUNTS[1:], 1):
        ahead = np.zeros_like(most)  # nothing follows a block, and nothing fits anywhere
        ahead[:, :BLOCK - (count - before)] = most[:, count - before:]
        most = np.maximum(most, ahead)
        fits = most <= BITS[selector]
        if not fits.any():
            break
        fit[fits] = selector
        before = count
    return fit


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a sequence of ids, and how many words each block takes. The last block may be short."""
    n_blocks = -(-len(ids) // BLOCK)
    values = np.zeros((n_blocks, BLOCK + 60), np.uint64)
    padded = np.zeros(n_blocks * BLOCK, np.uint64)
    padded[:len(ids)] = ids
    values[:, :BLOCK] = padded.reshape(n_blocks, BLOCK)
    size = np.full(n_blocks, BLOCK)
    if n_blocks:
        size[-1] = len(ids) - (n_blocks - 1) * BLOCK
    fit = _fitting(values[:, :BLOCK])
    step_of = np.append(COUNTS, [0, 1])
    at, block = np.zeros(n_blocks, np.int64), np.arange(n_blocks)
    steps = []
    while len(block):
        selector = fit[block, at[block]]
        steps.append((block, at[block], selector))
        at[block] += step_of[selector]
        block = block[at[block] < size[block]]
    if not steps:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    block, place, selector = (np.concatenate(c) for c in zip(*steps))
    order = np.argsort(block, kind="stable")
    block, place, selector = block[order], place[order], selector[order]
    taken = np.where(selector == ESCAPE, 2, 1)
    where = np.cumsum(taken) - taken
    words = np.zeros(int(taken.sum()), np.uint64)
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[where[own]] = np.uint64(ESCAPE << 60)
            words[where[own] + 1] = values[block[own], place[own]]
            continue
        packed = np.full(len(own), int(s) << 60, np.uint64)
        for k in range(COUNTS[s]):
            packed |= values[block[own], place[own] + k] << np.uint64(k * int(BITS[s]))
        words[where[own]] = packed
    return words, np.bincount(block, weights=taken, minlength=n_blocks).astype(np.int64)


def decode(words: np.ndarray, block_words: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of whole blocks; ``n_ids`` is the number of ids in them, all blocks but the last being full."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE):  # escapes are rare; the word after one is no selector
        if not raw[i]:
            raw[i + 1] = True
    block = np.repeat(np.arange(len(block_words)), block_words)
    count = np.append(COUNTS, [0, 1])[selector]
    count[raw] = 0
    ends = np.cumsum(count)
    start = ends - count
    first = np.concatenate(([0], np.cumsum(block_words)[:-1])).astype(np.int64)
    start = start - start[first][block] + block * BLOCK if len(words) else start
    ids = np.zeros(len(block_words) * BLOCK + 60, np.uint64)
    for s in np.unique(selector[~raw]):
        own = np.flatnonzero((selector == s) & ~raw)
        if s == ESCAPE:
            ids[start[own]] = words[own + 1]
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        stop = (block[own] + 1) * BLOCK
        for k in range(COUNTS[s]):
            value = (words[own] >> np.uint64(k * int(BITS[s]))) & mask
            inside = start[own] + k < stop
            ids[(start[own] + k)[inside]] = value[inside]
    return ids[:n_ids]
