"""Small sequential models: what the Spark jobs must agree with."""

from collections import Counter


def first_kept(bands):
    """Order values kept by the walk; bands is [(order, keys)]."""
    seen, kept = set(), []
    for order, keys in sorted(bands):
        if seen.isdisjoint(keys):
            kept.append(order)
            seen.update(keys)
    return kept


def merge_once(symbols, pair, new):
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def train(words, byte_ids, specials, vocab_size, min_frequency):
    """One merge at a time. A merge that spells an existing token reuses its id."""
    tokens = [t.encode() for t in specials] + [bytes([b]) for b, _ in sorted(byte_ids.items(), key=lambda kv: kv[1])]
    index = {t: i for i, t in enumerate(tokens)}
    state = [([byte_ids[b] for b in w.encode()], n) for w, n in words.items()]
    merges = []
    while len(tokens) < vocab_size:
        counts = Counter()
        for symbols, n in state:
            for pair in zip(symbols, symbols[1:]):
                counts[pair] += n
        if not counts:
            break
        pair, n = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        if n < min_frequency:
            break
        text = tokens[pair[0]] + tokens[pair[1]]
        if text not in index:
            index[text] = len(tokens)
            tokens.append(text)
        state = [(merge_once(s, pair, index[text]), c) for s, c in state]
        merges.append((*pair, index[text], n))
    return tokens, merges


def encode(symbols, merges):
    """Best rank first, leftmost first, one place at a time."""
    ranks = {(a, b): (r, new) for r, (a, b, new, _) in enumerate(merges)}
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return symbols
        _, i = min(found)
        symbols = symbols[:i] + [ranks[symbols[i], symbols[i + 1]][1]] + symbols[i + 2 :]
