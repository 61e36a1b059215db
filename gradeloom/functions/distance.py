"""Edit distances of many pairs at once, for use inside a task.

Spark's ``levenshtein`` fills one table cell at a time. The bit-parallel method of Myers (1999),
in the multi-word form of Hyyrö (2003), handles 64 cells per step, and numpy carries it out for
all pairs of a tile together: about forty times faster per pair.
"""

from __future__ import annotations

import numpy as np

WORD = 64
# Bounds the memory of one step, whatever the size of the tile.
KEYS_AT_ONCE = 32
PAIRS_AT_ONCE = 8_192
BOUNDS_AT_ONCE = 4_194_304
#: Letters are counted in so many groups for the lower bound.
GROUPS = 40


def _letters(texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]


def _one_width(keys: list[np.ndarray], words: int, texts: np.ndarray, lengths: np.ndarray, alphabet: int) -> np.ndarray:
    """Distances for keys that all take ``words`` machine words. ``texts`` is padded."""
    one, full = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    last = np.array([len(k) for k in keys], dtype=np.int64)
    places = np.zeros((words, len(keys), alphabet), dtype=np.uint64)
    for row, key in enumerate(keys):
        at = np.arange(len(key))
        np.bitwise_or.at(places, (at // WORD, row, key), one << (at % WORD).astype(np.uint64))
    top = [np.full((len(keys), 1), one << np.uint64(WORD - 1)) for _ in range(words - 1)]
    top.append((one << ((last - 1) % WORD).astype(np.uint64))[:, None])

    shape = (len(keys), len(lengths))
    plus = [np.full(shape, full) for _ in range(words)]
    minus = [np.zeros(shape, dtype=np.uint64) for _ in range(words)]
    score = np.broadcast_to(last[:, None], shape).astype(np.int64)
    for step in range(texts.shape[1]):
        up, down = np.ones(shape, dtype=bool), np.zeros(shape, dtype=bool)
        for w in range(words):
            vp, vn = plus[w], minus[w]
            same = places[w][:, texts[:, step]]
            xv = same | vn
            same = same | down.astype(np.uint64)
            xh = (((same & vp) + vp) ^ vp) | same
            hp, hn = vn | ~(xh | vp), vp & xh
            next_up, next_down = (hp & top[w]) != 0, (hn & top[w]) != 0
            hp, hn = (hp << one) | up.astype(np.uint64), (hn << one) | down.astype(np.uint64)
            plus[w], minus[w] = hn | ~(xv | hp), hp & xv
            up, down = next_up, next_down
        score += np.where(step < lengths, up.astype(np.int64) - down, 0)
    return score


def edit_distances(keys: list[str], texts: list[str]) -> np.ndarray:
    """Matrix of edit distances, one row per key and one column per text."""
    result = np.zeros((len(keys), len(texts)), dtype=np.int64)
    if not keys or not texts:
        return result
    coded_keys, coded_texts = _letters(keys), _letters(texts)
    signs = np.unique(np.concatenate(coded_keys + coded_texts + [np.zeros(1, dtype=np.uint32)]))
    lengths = np.array([len(t) for t in coded_texts])
    padded = np.zeros((len(texts), lengths.max()), dtype=np.int64)
    for row, text in enumerate(coded_texts):
        padded[row, : len(text)] = np.searchsorted(signs, text)
    widths = np.array([-(-len(k) // WORD) for k in coded_keys])
    for words in np.unique(widths):
        rows = np.flatnonzero(widths == words)
        if words == 0:
            result[rows] = lengths
            continue
        for start in range(0, len(rows), KEYS_AT_ONCE):
            some = rows[start : start + KEYS_AT_ONCE]
            same_width = [np.searchsorted(signs, coded_keys[r]) for r in some]
            result[some] = _one_width(same_width, int(words), padded, lengths, len(signs))
    return result


def _pair_step(places: list[np.ndarray], last: np.ndarray, signs: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distances of single pairs: ``at`` is where each pair's key begins in ``places``, ``signs`` has one row per step."""
    words, one, full = len(places), np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    top = [np.full(len(at), one << np.uint64(WORD - 1)) for _ in range(words - 1)]
    top.append(one << ((last - 1) % WORD).astype(np.uint64))
    plus, minus = [np.full(len(at), full) for _ in range(words)], [np.zeros(len(at), dtype=np.uint64) for _ in range(words)]
    score = last.copy()
    for step in range(int(lengths.max())):
        up, down = np.ones(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.uint64)
        where = at + signs[step]
        for w in range(words):
            vp, vn = plus[w], minus[w]
            same = places[w].take(where)
            xv = same | vn
            same |= down
            xh = (((same & vp) + vp) ^ vp) | same
            hp, hn = vn | ~(xh | vp), vp & xh
            next_up, next_down = ((hp & top[w]) != 0).astype(np.uint64), ((hn & top[w]) != 0).astype(np.uint64)
            hp, hn = (hp << one) | up, (hn << one) | down
            plus[w], minus[w] = hn | ~(xv | hp), hp & xv
            up, down = next_up, next_down
        score += np.where(step < lengths, up.astype(np.int64) - down.astype(np.int64), 0)
    return score


def _unary(counts: np.ndarray, held: np.ndarray) -> list[np.ndarray]:
    """Words of 64 bits: for each column of ``counts``, of up to ``held`` bits as many as the count are set."""
    bits = [counts[:, g] > n for g in range(len(held)) for n in range(held[g])]
    bits += [np.zeros(len(counts), dtype=bool)] * (-len(bits) % 64)
    words = np.packbits(np.array(bits, dtype=bool).reshape(len(bits), len(counts)).T, axis=1)
    return list(np.ascontiguousarray(np.ascontiguousarray(words).view(np.uint64).T)) if bits else []


def _coded(texts: list[str], signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The length of each text; of all letters of all texts, one after another, the number of the sign, the text and the place in it."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return lengths, np.searchsorted(signs, _letters(["".join(texts)])[0]), owner, place


def _group_counts(letters: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(owner * GROUPS + letters % GROUPS, minlength=texts * GROUPS).reshape(texts, GROUPS).astype(np.int32)


def near_pairs(
    keys: list[str], texts: list[str], most: np.ndarray, enough: int | None = None, worth: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, text and distance of all pairs whose distance is at most ``most`` of the key, in this order.

    Letters that one side has more of must be taken out or changed, so their number, of the side with more
    of them, is a lower bound. Only pairs within it are compared: a quarter of those of school names at
    four tenths of the length, a hundredth at one tenth. Where the ``enough`` nearest texts of a key and all as near
    as the last of them will do, pairs are compared by rising bound, and a key is done once so many are no farther
    than the bound of the pairs left; farther pairs of it may be missing. A text counts as many as its ``worth``, else one.
    """
    nothing = np.zeros(0, dtype=np.int64)
    if not keys or not texts:
        return nothing, nothing, nothing
    signs = np.unique(np.concatenate(_letters(["".join(keys), "".join(texts)]) + [np.zeros(1, dtype=np.uint32)]))
    own, key_letters, key_of, key_place = _coded(keys, signs)
    lengths, text_letters, text_of, text_place = _coded(texts, signs)
    padded = np.zeros((int(lengths.max()) + 1, len(texts)), dtype=np.int32)
    padded[text_place, text_of] = text_letters
    of_keys, of_texts = _group_counts(key_letters, key_of, len(keys)), _group_counts(text_letters, text_of, len(texts))
    # Letters a pair has in common are bits in common, as many bits as a side has of each letter.
    held = np.minimum(of_keys.max(axis=0), of_texts.max(axis=0))
    key_bits, text_bits = (_unary(of, held) for of in (of_keys, of_texts))
    worth = np.ones(len(texts), dtype=np.int64) if worth is None else worth
    rising, found = enough is not None and 4 * enough < worth.sum(), []
    step = max(64, BOUNDS_AT_ONCE // len(texts))
    for start in range(0, len(keys), step):
        part = slice(start, start + step)
        least = np.maximum(own[part, None], lengths[None, :]).astype(np.int32)
        for a, b in zip(key_bits, text_bits, strict=True):
            least -= np.bitwise_count(a[part, None] & b[None, :])
        row, column = np.nonzero(least <= most[part, None])
        bound, mine, below = least[row, column], [], 0
        some = (key_of >= start) & (key_of < start + step)
        tables = _sign_tables(own[part], key_letters[some], key_of[some] - start, key_place[some], len(signs))
        while len(row):
            below = 2 * below + 2 if rising else int(bound.max()) + 1
            now = bound < below
            mine.append(_compared(tables, own[part], lengths, padded, most[part], row[now], column[now]))
            known = sum(np.bincount(r[d < below], weights=worth[c[d < below]], minlength=len(own[part])) for r, c, d in mine)
            left = ~now & (known < (enough or 0))[row]
            row, column, bound = row[left], column[left], bound[left]
        found += [(r + start, c, d) for r, c, d in mine]
    return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (nothing, nothing, nothing)


def _sign_tables(own: np.ndarray, letters: np.ndarray, owner: np.ndarray, place: np.ndarray, signs: int) -> list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For keys of each number of machine words: which they are, where each key's part begins, and by word the places of each sign in a key."""
    widths = -(-own // WORD)
    tables = []
    for words in np.unique(widths):
        which = widths == words
        begin = np.where(which, np.cumsum(which) - 1, 0) * signs
        places = [np.zeros(which.sum() * signs, dtype=np.uint64) for _ in range(words)]
        for w in range(words):
            here = which[owner] & (place // WORD == w)
            np.bitwise_or.at(places[w], begin[owner[here]] + letters[here], np.uint64(1) << (place[here] % WORD).astype(np.uint64))
        tables.append((which, begin, places))
    return tables


def _compared(
    tables: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]], own: np.ndarray, lengths: np.ndarray, padded: np.ndarray,
    most: np.ndarray, row: np.ndarray, column: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the pairs ``row``, ``column`` whose distance is at most ``most`` of the key, and the distance."""
    dist = np.zeros(len(row), dtype=np.int64)
    for which, begin, places in tables:
        pairs = np.flatnonzero(which[row])
        if not places:
            dist[pairs] = lengths[column[pairs]]
            continue
        pairs = pairs[np.argsort(lengths[column[pairs]], kind="stable")]
        for start in range(0, len(pairs), PAIRS_AT_ONCE):
            some = pairs[start:start + PAIRS_AT_ONCE]
            size = lengths[column[some]]
            longest = int(size.max())
            dist[some] = _pair_step(places, own[row[some]], padded[:longest].take(column[some], axis=1), size, begin[row[some]]) if longest else own[row[some]]
    near = dist <= most[row]
    return row[near], column[near], dist[near]
