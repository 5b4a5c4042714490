"""Deep-shallow sorting of strings that begin alike.

Multikey quicksort orders them to a shallow depth; what is still tied there has
a long common prefix and is ordered by a blind trie, which looks at few bytes
of each string.
"""

from __future__ import annotations

SHALLOW = 16


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] agrees, a[:high] doesn't
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Sorts strings by their branching bytes; a string is compared once, with one leaf.

    Nodes are ``[depth, children by byte, members that end or are equal there]``.
    Byte -1 is the end of a string.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None

    def _byte(self, member: int, depth: int) -> int:
        s = self.strings[member]
        return s[depth] if depth < len(s) else -1

    def _leaf(self, member: int) -> list:
        return [len(self.strings[member]), {}, [member]]

    def add(self, member: int) -> None:
        if self.root is None:
            self.root = self._leaf(member)
            return
        path, node = [self.root], self.root
        while node[1]:
            child = node[1].get(self._byte(member, node[0]))
            if child is None:
                child = next(iter(node[1].values()))
            path.append(child)
            node = child
        met = node[2][0]
        depth = common_prefix(self.strings[member], self.strings[met])
        if depth == len(self.strings[member]) == len(self.strings[met]):
            node[2].append(member)
            return
        # the first node of the path that is at least as deep as the difference
        place = next(i for i, n in enumerate(path) if n[0] >= depth)
        node = path[place]
        if node[0] == depth and node[1]:
            node[1][self._byte(member, depth)] = self._leaf(member)
            return
        branch = [depth, {self._byte(met, depth): node, self._byte(member, depth): self._leaf(member)}, []]
        if place:
            parent = path[place - 1]
            parent[1][self._byte(met, parent[0])] = branch
        else:
            self.root = branch

    def order(self) -> list[int]:
        out: list[int] = []
        pending = [self.root] if self.root else []
        while pending:
            node = pending.pop()
            out += node[2]
            pending += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow_order(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Positions of the strings in order; all agree on the first ``depth`` bytes."""
    end = depth + shallow
    out: list[int] = []
    pending = [(list(range(len(strings))), depth)]
    while pending:
        members, at = pending.pop()
        if len(members) < 2:
            out += members
            continue
        if at >= end:
            trie = BlindTrie(strings)
            for member in members:
                trie.add(member)
            out += trie.order()
            continue
        keys = [s[at] if at < len(s) else -1 for s in map(strings.__getitem__, members)]
        pivot = keys[len(keys) // 2]
        less, same, more = [], [], []
        for member, key in zip(members, keys, strict=True):
            (less if key < pivot else more if key > pivot else same).append(member)
        pending.append((more, at))
        if pivot < 0:  # strings that end here are equal, and nothing sorts before them
            out += same
        else:
            pending.append((same, at + 1))
            pending.append((less, at))
    return out
