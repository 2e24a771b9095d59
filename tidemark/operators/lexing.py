"""Where the code of a source is: an automaton with a stack, driven by a table of literals for each language.

Strings, templates, comments, regular expressions and here-documents are literals; what stands in a literal's holes (as in a
template) is code again, to any depth. :func:`blanked` keeps the code and the line ends and turns all else into blanks, so that
brackets in what is left are brackets of the program.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache


@dataclass(frozen=True)
class Literal:
    """``opens`` and ``closes`` are patterns; ``escape`` is what hides the character behind it, or a doubled close."""

    opens: str
    closes: str
    escape: str = ""
    hole: tuple[str, str] | None = None
    one_line: bool = False
    comment: bool = False


LINE, BLOCK = Literal("//", r"(?=\n)", comment=True), Literal(r"/\*", r"\*/", comment=True)
QUOTED, CHARACTER = Literal('"', '"', r"\\.", one_line=True), Literal("'", "'", r"\\.", one_line=True)
SCRIPT = (LINE, BLOCK, QUOTED, CHARACTER, Literal("`", "`", r"\\.", (r"\$\{", "{}")))
LITERALS = {
    "javascript": SCRIPT,
    "typescript": SCRIPT,
    "tsx": SCRIPT,
    "go": (LINE, BLOCK, QUOTED, CHARACTER, Literal("`", "`")),
    "csharp": (
        LINE, BLOCK, Literal('\\$*"""', '"""'), Literal(r'(?:\$@|@\$)"', '"', r'""|\{\{', (r"\{", "{}")), Literal('@"', '"', '""'),
        Literal(r'\$"', '"', r"\\.|\{\{", (r"\{", "{}"), one_line=True), QUOTED, CHARACTER,
    ),
    "bash": (Literal(r"(?<![^\s;&|()])#", r"(?=\n)", comment=True), Literal(r"\\.", ""), Literal(r"\$'", "'", r"\\."), Literal("'", "'"), Literal('"', '"', r"\\.", (r"\$\(", "()"))),
}
#: A slash begins a regular expression where no operand stands before it: behind one of these words, or behind no word or bracket.
SLASH = {"javascript", "typescript", "tsx"}
BEFORE_PATTERN = {"return", "typeof", "case", "in", "of", "delete", "void", "throw", "new", "do", "else", "yield", "await", "instanceof"}
PATTERN = re.compile(r"/(?![/*])(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\[\n])+/[a-z]*")
HEREDOC = r"(?<!<)<<(?!<)-?[ \t]*(?P<mark>['\"]?)[A-Za-z_]\w*(?P=mark)"


@cache
def openers(lang: str) -> re.Pattern:
    """The next thing that matters in code: a literal of one of the groups, a bracket, a slash, a here-document or a line end."""
    parts = [f"(?P<l{i}>{x.opens})" for i, x in enumerate(LITERALS[lang])]
    if lang in SLASH:
        parts.append("(?P<slash>/)")
    if lang == "bash":
        parts.append(f"(?P<here>{HEREDOC})")
    return re.compile("|".join([*parts, r"(?P<bracket>[{}()])", r"(?P<end>\n)"]), re.DOTALL)


@cache
def stops(literal: Literal) -> re.Pattern:
    """The next thing that matters in a literal."""
    parts = [f"(?P<skip>{literal.escape})"] if literal.escape else []
    if literal.hole:
        parts.append(f"(?P<hole>{literal.hole[0]})")
    parts.append(f"(?P<close>{literal.closes})")
    if literal.one_line:
        parts.append(r"(?P<lost>(?=\n))")
    return re.compile("|".join(parts), re.DOTALL)


def begins_pattern(source: str, at: int) -> bool:
    before = source[max(0, at - 64) : at].rstrip()
    word = re.search(r"[\w$]+$", before)
    return word[0] in BEFORE_PATTERN if word else before[-1:] not in (")", "]", "}")


def blanked(lang: str, source: str) -> str:
    """``source`` with blanks for all that isn't code, of the same length and lines; a value that was written out
    leaves a quote at its end. A literal that never closes ends with its line
    where it can't hold more than one, else with the source."""
    kept, at, code_from = [], 0, 0
    stack: list[tuple[Literal, str, int]] = []  # open holes: their literal, its bracket pair, and open brackets within
    waiting: list[tuple[bool, str]] = []  # here-documents that begin behind this line

    def blank(start: int, end: int, value: bool = True) -> None:
        text = re.sub(r"[^\n]", " ", source[start:end])
        kept.append(text[:-1] + '"' if value and text[-1:] == " " else text)

    def leave(literal: Literal, start: int) -> int:
        """Reads on in a literal; returns where code goes on."""
        for found in stops(literal).finditer(source, start):
            if found.lastgroup == "skip":
                continue
            if found.lastgroup == "hole":
                stack.append((literal, literal.hole[1], 0))
            return found.end()
        return len(source)

    while found := openers(lang).search(source, at):
        kind, start, at = found.lastgroup, found.start(), found.end()
        if kind == "bracket":
            if stack:
                literal, pair, depth = stack[-1]
                depth += (found[0] == pair[0]) - (found[0] == pair[1])
                stack[-1] = (literal, pair, depth)
                if depth < 0:
                    stack.pop()
                    kept.append(source[code_from:start])
                    at = code_from = leave(literal, at)
                    blank(start, at)
        elif kind == "here":
            waiting.append((found[0].startswith("<<-"), re.search(r"[A-Za-z_]\w*", found[0])[0]))
        elif kind == "end":
            for dash, word in waiting:
                close = re.compile(rf"^{chr(9) + '*' if dash else ''}{word}$", re.MULTILINE).search(source, at)
                kept.append(source[code_from:at])
                end = close.end() if close else len(source)
                blank(at, end, value=False)
                at = code_from = end
            waiting = []
        else:
            comment = False
            if kind == "slash":
                pattern = PATTERN.match(source, start) if begins_pattern(source, start) else None
                if not pattern:
                    continue
                end = pattern.end()
            else:
                literal = LITERALS[lang][int(kind[1:])]
                comment, end = literal.comment, leave(literal, at)
            kept.append(source[code_from:start])
            blank(start, end, not comment)
            at = code_from = end
    kept.append(source[code_from:])
    return "".join(kept)
