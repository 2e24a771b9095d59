import pytest

from tidemark.operators import chunking, lexing


def found(lang, source):
    return [(name, a + 1, b) for a, b, name in chunking.definitions(lang, source)]


@pytest.mark.parametrize(("lang", "source", "code"), [
    ("javascript", "a = '}' // {\nb = /[/{]/g / 2", "a =         \nb =          / 2"),
    ("javascript", "x = `a${f({b: `}`})}c{`; y", "x =     f({b:    })    ; y"),
    ("javascript", "r = a / b / c; return /}/", "r = a / b / c; return    "),
    ("go", "s := `a\n{` + \"\\\"}\" // }", "s :=   \n   +            "),
    ("csharp", 'a = @"x""{" + $"{b("}")}{{" + """ " """;', "a =         +    b(   )     +          ;"),
    ("bash", "echo ${#a} '{' \"$(f \"}\")}\" # {\n", "echo ${#a}         f             \n"),
    ("bash", "cat <<-'E' # {\n{ x\n\tE\n}", "cat <<-'E'    \n   \n  \n}"),
])
def test_only_code_is_left(lang, source, code):
    got = lexing.blanked(lang, source)
    assert len(got) == len(source) and got.count("\n") == source.count("\n")
    assert got.replace('"', " ").split() == code.split()


def test_what_never_closes():
    assert lexing.blanked("go", 's := "abc\n}') == 's :=    "\n}' and lexing.blanked("javascript", "/* {").strip() == ""
    assert lexing.blanked("bash", "cat <<E\n{\n") .strip() == "cat <<E" and lexing.blanked("go", "") == ""


def test_brackets_in_literals_move_no_boundary():
    assert found("javascript", "function a() {\n  return '}' + `${{}}` // }\n}\n\nclass B {\n}\n") == [("a", 1, 3), ("B", 5, 6)]
    assert found("go", "func f(x interface{}) interface{} {\n\treturn '}'\n}\ntype T struct {\n\tA int `json:\"}\"`\n}\ntype N int\n") == [("f", 1, 3), ("T", 4, 6), ("N", 7, 7)]
    assert found("csharp", "namespace A;\n\npublic class B\n    : C\n{\n  string s = \"}\";\n}\n") == [("A", 1, 1), ("B", 3, 7)]
    assert found("bash", "f() {\n  cat <<E\n}\nE\n  echo ${a:-}}\n}\ng() (\n  echo \"(\"\n)\n")[-1][0] == "g"
    assert found("typescript", "export type A =\n  | '{'\n  | 'b'\ninterface I\n{\n  x: '}'\n}\n")[:1] == [("A", 1, 3)]
    assert found("go", "func f() {\n  x\n") == [("f", 1, 2)] and found("go", "") == [] and found(None, "x") == []


def test_nested_declarations_are_not_of_the_top():
    assert found("javascript", "(() => {\nfunction a() {\n}\n})();\nfunction b() {}\n") == [("b", 5, 5)]
