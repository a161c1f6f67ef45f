"""Finding the end of bracketed source text, past quotes and comments."""

import re

QUOTED = r'"(?:[^"\\]+|\\.)*"?' + r"|'(?:[^'\\]+|\\.)*'?" + r"|`(?:[^`\\]+|\\.)*`?"
COMMENT = r"//[^\n]*|/\*(?:[^*]+|\*(?!/))*(?:\*/)?"

QUOTES_AND_BRACKETS = re.compile(QUOTED + r"|[()\[\]{}]", re.DOTALL)
CODE_PIECES = re.compile(COMMENT + "|" + QUOTED + r"|[()\[\]{},]", re.DOTALL)

BRACES = {"{": "}"}
PARENS = {"(": ")"}
BRACKETS = {"(": ")", "[": "]", "{": "}"}


# Pieces read for one question before the whole text is indexed.
DIRECT = 200


class BracketIndex:
    """Where brackets close and which commas part their contents, for any start in a text.

    What a scan sees after some place depends on that place alone, so scans that meet go on alike.
    Every piece is read once, however many scans begin before it, and keeps the next bracket of
    each kind that closes something opened before it, and the next comma outside of later
    brackets. Both follow from what lies behind: past an opening bracket that of the place
    where it closes, past anything else that of the next piece. Nothing is read before it is asked for.
    """

    def __init__(self, text, pieces, pairs):
        self.text, self.pieces, self.pairs = text, pieces, pairs
        self._kinds = {close: k for k, close in enumerate(pairs.values())}
        self._ahead = {}  # start of a piece -> closing brackets by kind, then the comma
        self._behind = {}  # start of a closing bracket -> the same for what follows it

    def ahead(self, at):
        """Next closing bracket of each kind and next comma for a scan that begins at ``at``."""
        path, found = [], (None,) * (len(self._kinds) + 1)
        for piece in self.pieces.finditer(self.text, at):
            if piece.start() in self._ahead:
                found = self._ahead[piece.start()]
                break
            path.append((piece.start(), piece.group()))
        for start, mark in reversed(path):
            if mark in self.pairs:
                close = found[self._kinds[self.pairs[mark]]]
                found = (None,) * len(found) if close is None else self._behind[close]
            elif mark in self._kinds:
                self._behind[start] = found
                kind = self._kinds[mark]
                found = (*found[:kind], start, *found[kind + 1 :])
            elif mark == ",":
                found = (*found[:-1], start)
            self._ahead[start] = found
        return found

    def close(self, at, bracket):
        """Start of the ``bracket`` that closes what was opened just before ``at``."""
        return self.ahead(at)[self._kinds[bracket]]

    def comma(self, at):
        """Start of the next comma from ``at`` on, outside of brackets that open later."""
        return self.ahead(at)[-1]


def closing(text, start, pairs, index=None):
    """Position after the bracket that closes the first one from ``start`` on.

    With an ``index`` of the text no scan is long: those that are not over soon look it up.
    """
    due, opened = [], None
    for read, piece in enumerate(QUOTES_AND_BRACKETS.finditer(text, start)):
        mark = piece.group()
        if mark in pairs:
            opened = opened or piece
            due.append(pairs[mark])
        elif due and mark == due[-1]:
            due.pop()
            if not due:
                return piece.end()
        if index is not None and opened and read > DIRECT:
            close = index.close(opened.end(), pairs[opened.group()])
            return None if close is None else close + 1
    return None


def call_arguments(text, start, wanted, index=None):
    """Up to ``wanted`` arguments of the call whose ``(`` ends at ``start``.

    Stops as soon as it has them, so long handler bodies are never read. A call
    that never closes gives the arguments that ended with a comma. For ``index`` see ``closing``.
    """
    arguments, due, begin = [], [")"], start
    for read, piece in enumerate(CODE_PIECES.finditer(text, start)):
        if index is not None and read > DIRECT:
            return _indexed_arguments(text, start, wanted, index)
        mark = piece.group()
        if mark in BRACKETS:
            due.append(BRACKETS[mark])
            continue
        if mark == due[-1]:
            due.pop()
        if not due or (mark == "," and len(due) == 1):
            argument = text[begin : piece.start()].strip()
            begin = piece.end()
            arguments += [argument] if argument else []
            if not due or len(arguments) == wanted:
                break
    return arguments


def _indexed_arguments(text, start, wanted, index):
    arguments, begin, end = [], start, index.close(start, ")")
    while len(arguments) < wanted:
        stop = index.comma(begin)
        last = stop is None or (end is not None and end < stop)
        if last and end is None:
            break
        argument = text[begin : end if last else stop].strip()
        arguments += [argument] if argument else []
        if last:
            break
        begin = stop + 1
    return arguments


def code_index(text):
    """Index for ``call_arguments``."""
    return BracketIndex(text, CODE_PIECES, BRACKETS)


def bracket_index(text, pairs):
    """Index for ``closing`` with these ``pairs``."""
    return BracketIndex(text, QUOTES_AND_BRACKETS, pairs)
