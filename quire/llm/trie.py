"""Levenshtein automata run against a trie.

The automaton of a word is simulated as the set of its positions while the trie
is walked, so only prefixes that can still match are visited and every entry
within reach is found.  Beside the plain edits the automaton may read one
spelling as another (``swaps``: what stands there -> what it may mean).
"""

from __future__ import annotations

END = ""


def build(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[END] = w
    return root


def search(root: dict, word: str, swaps: dict[str, list[tuple[str, str]]], max_swaps: int = 2, max_edits: int = 1, wild: str = "", both: bool = False, turned: bool = False) -> dict[str, tuple[int, int]]:
    """Entries within ``max_swaps`` swaps, or within ``max_edits`` plain edits, each
    with its least (edits, swaps); with ``both`` also within as many of either.

    ``swaps`` lists by first character the pairs (seen, meant); the character
    ``wild`` of the word stands for any one.  With ``turned`` two characters in
    each other's place are one edit.
    """
    n, found = len(word), {}
    stack, seen = [(root, 0, 0, 0)], set()
    while stack:
        node, i, edits, used = stack.pop()
        state = (id(node), i, edits, used)
        if state in seen:
            continue
        seen.add(state)
        if i == n:
            if END in node:
                w = node[END]
                if w not in found or (edits, used) < found[w]:
                    found[w] = (edits, used)
        else:
            ch = word[i]
            if ch in node:
                stack.append((node[ch], i + 1, edits, used))
            if ch == wild:
                stack.extend((to, i + 1, edits, used) for c, to in node.items() if c)
            if (both or not edits) and used < max_swaps and ch in swaps:
                for seen_as, meant in swaps[ch]:
                    if word.startswith(seen_as, i):
                        to = node
                        for c in meant:
                            to = to.get(c)
                            if to is None:
                                break
                        else:
                            stack.append((to, i + len(seen_as), edits, used + 1))
        if (both or not used) and edits < max_edits:
            if i < n:
                stack.append((node, i + 1, edits + 1, used))
            if turned and i + 1 < n and word[i] in node.get(word[i + 1], ()):
                stack.append((node[word[i + 1]][word[i]], i + 2, edits + 1, used))
            for c, to in node.items():
                if c:
                    stack.append((to, i, edits + 1, used))
                    if i < n:
                        stack.append((to, i + 1, edits + 1, used))
    return found
