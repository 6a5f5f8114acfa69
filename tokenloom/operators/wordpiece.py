"""Longest-match WordPiece in time linear in the text: a trie with failure links.

Published as LinMaxMatch (Song et al., "Fast WordPiece Tokenization", 2021). A node's failure
link tells where matching goes on when no token continues, and its pops are the tokens
that are then settled. Both follow from the parent's, breadth first.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable


class LongestMatch:
    """Ids of the longest tokens from left to right; after the first, tokens must begin with ``prefix``."""

    def __init__(self, tokens: Iterable[str], prefix: str = "##") -> None:
        self.next: list[dict[str, int]] = [{}, {}]  # the roots of whole tokens and of those inside a word
        ends: list[int | None] = [None, None]
        for number, token in enumerate(tokens):
            for root, name in ((0, token), (1, token[len(prefix):] if token.startswith(prefix) else "")):
                node = root
                for char in name:
                    after = self.next[node].get(char)
                    if after is None:
                        after = self.next[node][char] = len(self.next)
                        self.next.append({})
                        ends.append(None)
                    node = after
                if name:
                    ends[node] = number
        self.fail: list[int | None] = [None] * len(self.next)
        self.pops: list[tuple[int, ...]] = [()] * len(self.next)
        queue = deque((0, 1))
        while queue:
            parent = queue.popleft()
            for char, node in self.next[parent].items():
                queue.append(node)
                if ends[node] is not None:
                    self.fail[node], self.pops[node] = 1, (ends[node],)
                    continue
                at, settled = self.fail[parent], list(self.pops[parent])
                while at is not None and char not in self.next[at]:
                    settled += self.pops[at]
                    at = self.fail[at]
                if at is not None:
                    self.fail[node], self.pops[node] = self.next[at][char], tuple(settled)

    def __call__(self, text: str, inside: bool = False) -> list[int] | None:
        """The ids, or nothing where some part has no match; ``inside`` tells that a token went before."""
        out: list[int] = []
        at = int(inside)
        for char in text:
            while char not in self.next[at]:
                if self.fail[at] is None:
                    return None
                out += self.pops[at]
                at = self.fail[at]
            at = self.next[at][char]
        while at > 1:
            if self.fail[at] is None:
                return None
            out += self.pops[at]
            at = self.fail[at]
        return out
