"""Problem 7: source files that do not parse, by the cost of the cheapest repair.

A file is cut into tokens by its language's lexical rules, brackets (and Python's indented blocks) become groups, and the
error-correcting chart parser (chart.py) gives each statement's least number of edits. Lexical faults (an open string, a
stray character, a bracket without partner) count as edits too. A cost above 0 flags the file; the places of the edits
tell the cause: all at the end of the file: truncation; within conflict markers: conflict; a file that another language
parses at less cost, or that needs CAP edits or more: mismatch; else damage. Where Python and strict JSON have an exact
parser at hand, it confirms the flags. Costs are counted to the end.

Languages: Python 3.13, JavaScript as an ES module, TypeScript, strict JSON; labels are read without case and outer
blanks, a null label is replaced by what the file name's ending says.

Cases: null code is not a file and is not flagged; empty files are valid but for JSON; labels of other languages are not
checked; texts are read whole; a byte order mark is allowed at the start but for JSON.
"""

from __future__ import annotations

import ast
import json
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.chart import Grammar, Parser

CAP = 12
LANGUAGES = ("python", "javascript", "typescript", "json")
# The languages of file names' endings.
ENDINGS = {"py": "python", "pyi": "python", "pyw": "python", "js": "javascript", "jsx": "javascript", "mjs": "javascript", "cjs": "javascript", "ts": "typescript", "mts": "typescript", "cts": "typescript", "tsx": "typescript", "json": "json"}


def language_of(label: str | None, path: str | None) -> str | None:
    if label is not None:
        name = label.strip().lower()
        return name if name in LANGUAGES else None
    return ENDINGS.get((path or "").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower())


# ---- grammars (own formulations of the public language references)

_SCRIPT = r"""
Module: ( Import | Export | Item)*
End: ';' | 'NL'
Import: 'import' 'type'? ( ImportClause 'from')? str (('with' | 'assert') {Obj)? End | 'import' id '=' Expr End
ImportClause: id (',' ( Star | {Imports))? | Star | {Imports
Star: '*' 'as' id
Imports: ( ImportSpec (',' ImportSpec)* ','?)?
ImportSpec: 'type'? name | 'type'? (name | str) 'as' id
Export: 'export' '*' ('as' (name | str))? 'from' str (('with' | 'assert') {Obj)? End | 'export' 'type'? {Exports ('from' str (('with' | 'assert') {Obj)?)? End
Export: 'export' 'default' ( Func | Class | Assign End | TsDecl) | 'export' ( Lexical | VarStmt | FuncDecl | ClassDecl | TsDecl)
Exports: ( ExportSpec (',' ExportSpec)* ','?)?
ExportSpec: 'type'? (name | str) ('as' (name | str))?
Declared: Lexical | FuncDecl | ClassDecl | TsDecl
Plain: End | VarStmt | ExprN End | 'throw' Expr End | 'break' id End | 'continue' id End | 'debugger' End
ForHead: (('let' | 'var') Var (',' Var)* | 'const' CVar (',' CVar)* | Expr)? ';' Expr? ';' Expr? | ForLeft ('of' Assign | 'in' Expr)
ForLeft: ('const' | 'let' | 'var') Bound TypeAnn? | Ref | [Pattern | {ObjPattern
Catch: Bound TypeAnn?
Lexical: 'let' Var (',' Var)* End | 'const' CVar (',' CVar)* End
VarStmt: 'var' Var (',' Var)* End
Var: id '!'? TypeAnn? ('=' Assign)? | ([BPattern | {BObj) TypeAnn? '=' Assign
CVar: Bound TypeAnn? '=' Assign
Bound: id | [BPattern | {BObj
BPattern: ( BItem? ',')* ( BItem | '...' Bound)?
BItem: Bound ('=' Assign)?
BObj: ( BProp ',')* ( BProp | '...' id)?
BProp: id ('=' Assign)? | PropName ':' BItem
Place: Ref | [Pattern | {ObjPattern
Pattern: ( PatItem? ',')* ( PatItem | '...' Place)?
PatItem: Place ('=' Assign)?
ObjPattern: ( ObjItem ',')* ( ObjItem | '...' Ref)?
ObjItem: id ('=' Assign)? | PropName ':' PatItem
FuncDecl: 'async'? 'function' '*'? id FuncTail
Func: 'async'? 'function' '*'? id? FuncTail
FuncTail: TypeParams? (Params RetType? {StmtsR
ClassDecl: Decorator* 'abstract'? 'class' id ClassTail
Class: Decorator* 'abstract'? 'class' id? ClassTail
ClassTail: TypeParams? ('extends' Lhs TypeArgs?)? ('implements' TypeList)? {Members
Decorator: '@' id ('.' name)* (Args? 'NL'? | '@' (Expr 'NL'?
Members: ( Member | ';' | 'NL')*
Member: ( Mod | Decorator)* ('*'? PropName '?'? TypeParams? (Params RetType? ({StmtsR | TsEnd) | PropName ('?' | '!')? TypeAnn? ('=' Assign)? End) | 'static' {Stmts
Mod: 'static' | 'async' | 'get' | 'set' | 'accessor' | TsMod
PropName: name | str | num | [Assign
Params: ( Param ',')* ( Param | Decorator* '...' Bound TypeAnn?)?
Param: Decorator* TsMod* Bound '?'? TypeAnn? ('=' Assign)? | ThisParam
Expr: Assign (',' Assign)*
ExprN: AssignN (',' Assign)*
Assign: Cond | Ref AssignOp Assign | ([Pattern | {ObjPattern) '=' Assign | Arrow | Yield
AssignN: CondN | RefN AssignOp Assign | [Pattern '=' Assign | Arrow | Yield
Yield: 'yield' | 'yield' '*'? Assign
AssignOp: '=' | '+=' | '-=' | '*=' | '/=' | '%=' | '**=' | '<<=' | '&=' | '|=' | '^=' | '&&=' | '||=' | '??=' | '>' '>='  | '>' '>' '>='
Arrow: 'async'? (id | TypeParams? (Params RetType?) '=>' ({StmtsR | AssignN | ( Func | Class) Suffix*)
Cond: Bin ('?' Assign ':' Assign)?
CondN: BinN ('?' Assign ':' Assign)?
Bin: Unary ( BinOp Unary | AsType)*
BinN: UnaryN ( BinOp Unary | AsType)*
BinOp: '+' | '-' | '*' | '/' | '%' | '**' | '==' | '!=' | '===' | '!==' | '<' | '>' | '<=' | '>=' | '&&' | '||' | '??' | '&' | '|' | '^' | '<<' | '>' '>' | '>' '>' '>' | 'in' | 'instanceof'
UnOp: '!' | '~' | '+' | '-' | 'typeof' | 'void' | 'delete' | 'await' | Cast
Unary: UnOp* ( Lhs | Ref ('++' | '--') | ('++' | '--') Ref)
UnaryN: UnOp+ ( Lhs | Ref ('++' | '--') | ('++' | '--') Ref) | LhsN | RefN ('++' | '--') | ('++' | '--') Ref
Lhs: Primary Suffix*
LhsN: PrimaryN Suffix*
Ref: id | Primary Step* Last | (AsRef
RefN: id | PrimaryN Step* Last | (AsRef
AsRef: Ref AsType* | Cast Ref
Last: '.' name | [Expr | NonNull
Step: '.' name | [Expr | (Args | tpl | NonNull | TypeArgs (Args
Suffix: Step | '?.' name | '?.' ((Args | [Expr)
Primary: PrimaryN | {Obj | Func | Class
PrimaryN: id | num | str | tpl | re | 'this' | 'super' | 'null' | 'true' | 'false' | (Expr | [Elements | 'new' '.' name | 'new' Lhs | 'import' (Args | 'import' '.' name
Args: ( Arg (',' Arg)* ','?)?
Arg: '...'? Assign
Elements: Arg? (',' Arg?)*
Obj: ( Prop (',' Prop)* ','?)?
Prop: '...' Assign | id | PropName ':' Assign | ('async' | 'get' | 'set')? '*'? PropName TypeParams? (Params RetType? {StmtsR
"""
#: Statements where return (R), break (B), or break and continue (L) may stand: § is what is allowed, † the same within a loop,
#: ‡ within a switch. Declarations stand in lists of statements only, not where a single statement does.
_STATEMENTS = r"""
Stmts§: Item§*
Item§: Declared | Stmt§
Stmt§: {Stmts§ | If§ | For§ | While§ | Try§ | Switch§ | id ':' 'NL'? Stmt§ | Plain
If§: 'if' (Expr 'NL'? Stmt§ ('NL'? 'else' 'NL'? Stmt§)?
For§: 'for' 'await'? (ForHead 'NL'? Stmt†
While§: 'while' (Expr 'NL'? Stmt† | 'do' 'NL'? Stmt† 'NL'? 'while' (Expr End?
Try§: 'try' {Stmts§ 'NL'? ('catch' (Catch? {Stmts§ ('NL'? 'finally' {Stmts§)? | 'finally' {Stmts§)
Switch§: 'switch' (Expr {Cases‡
"""


def _script_grammar() -> str:
    out = _SCRIPT
    for r in ("", "R"):
        for where in ("", "B", "L"):
            at, inner = r + where, r + ("L" if where == "L" else "B")
            out += _STATEMENTS.replace("§", at).replace("†", r + "L").replace("‡", inner)
            out += f"Stmt{at}: 'return' Expr? End\n" if r else ""
            out += f"Stmt{at}: 'break' End\n" if where else ""
            out += f"Stmt{at}: 'continue' End\n" if where == "L" else ""
            out += f"Cases{at}: 'NL'* (('case' Expr | 'default') ':' Item{at}*)*\n" if where else ""
    return out


SCRIPT = _script_grammar()
TYPES = r"""
TsEnd: End
TsMod: 'public' | 'private' | 'protected' | 'readonly' | 'abstract' | 'override' | 'declare'
Member: ( Mod | Decorator)* [IndexSig TypeAnn End
ThisParam: 'this' TypeAnn
NonNull: '!'
Cast: '<' Type '>'
AsType: ('as' | 'satisfies') ( Type | 'const')
TypeAnn: ':' Type
RetType: ':' Type | ':' 'asserts'? (id | 'this') ('is' Type)? | ':' 'asserts' id
Type: Union ('extends' Type '?' Type ':' Type)? | Fn
Fn: 'abstract'? 'new'? TypeParams? (TParams '=>' ( Type | (id | 'this') 'is' Type | 'asserts' id ('is' Type)?)
TParams: ( TParam (',' TParam)* ','?)?
TParam: '...'? Bound '?'? TypeAnn? | ThisParam
Union: ('|' | '&')? TPost (('|' | '&') ( TPost | Fn))*
TPost: ('keyof' | 'readonly' | 'unique' | 'infer')? TPrim ([TIndex)* | 'infer' id 'extends' Type
TIndex: Type?
TPrim: Qual TypeArgs? | str | num | '-' num | tpl | 'null' | 'void' | 'this' | 'true' | 'false' | 'typeof' ( Qual TypeArgs? | 'import' (Args ('.' name)*) | (Type | {TypeObj | [Tuple | 'import' (Args ('.' name)* TypeArgs?
Qual: id ('.' name)*
Tuple: ( TupleItem (',' TupleItem)* ','?)?
TupleItem: '...'? (name '?'? ':')? Type '?'?
TypeList: Qual TypeArgs? (',' Qual TypeArgs?)*
TypeArgs: '<' Type (',' Type)* ','? '>'
TypeParams: '<' TypeParam (',' TypeParam)* ','? '>'
TypeParam: ('const' | 'in' | 'out')* id ('extends' Type)? ('=' Type)?
TypeObj: 'NL'* ( TMember ((';' | ',') 'NL'* | 'NL'+)?)*
TMember: ('readonly' | 'get' | 'set')* PropName '?'? TypeAnn? | ('get' | 'set')? PropName '?'? TypeParams? (TParams RetType? | TypeParams? (TParams RetType? | 'new' TypeParams? (TParams RetType? | 'readonly'? [IndexSig '?'? TypeAnn | ('+' | '-')? 'readonly'? [Mapped (('+' | '-')? '?')? TypeAnn
IndexSig: id TypeAnn
Mapped: id 'in' Type ('as' Type)?
TsDecl: 'interface' id TypeParams? ('extends' TypeList)? {TypeObj | 'type' id TypeParams? '=' Type End | 'const'? 'enum' id {Enum | 'declare' ( AVarDecl | FuncDecl | ClassDecl | TsDecl | 'global' {Ambient | ('namespace' | 'module') ( Qual | str) {Ambient) | ('namespace' | 'module') ( Qual | str) ({Module | End)
TsDecl: 'async'? 'function' '*'? id TypeParams? (Params RetType? End | 'abstract' 'class' id TypeParams? ('extends' Lhs TypeArgs?)? ('implements' TypeList)? {Members
Ambient: ( Import | Export | 'export'? AVarDecl | Item)*
AVarDecl: ('const' | 'let' | 'var') AVar (',' AVar)* End
AVar: id TypeAnn? ('=' Assign)?
Enum: ( EnumItem (',' EnumItem)* ','?)?
EnumItem: (name | str) ('=' Assign)?
Export: 'export' '=' Expr End | 'export' 'as' 'namespace' id End | 'export' 'import' id '=' Expr End
"""
NOTHING = ("TsEnd", "TsMod", "ThisParam", "NonNull", "Cast", "AsType", "TypeAnn", "RetType", "TypeList", "TypeArgs", "TypeParams", "TsDecl")
PYTHON = r"""
Stmts: Stmt*
Body: Stmt+
Stmt: Line | If | While | For | Try | With | Def | Class | Match
Line: Small (';' Small)* ';'? 'NL'
Block: 'NL' ⟦Body | Line
If: 'if' Named ':' Block ('elif' Named ':' Block)* ('else' ':' Block)?
While: 'while' Named ':' Block ('else' ':' Block)?
For: 'async'? 'for' Targets 'in' Stars ':' Block ('else' ':' Block)?
Try: 'try' ':' Block (('except' ( Test ('as' id)?)? ':' Block)+ ('else' ':' Block)? ('finally' ':' Block)? | ('except' '*' Test ('as' id)? ':' Block)+ ('else' ':' Block)? ('finally' ':' Block)? | 'finally' ':' Block)
With: 'async'? 'with' ( WithItem (',' WithItem)* | (WithItems) ':' Block
WithItem: Test ('as' Target)?
WithItems: WithItem (',' WithItem)* ','?
Deco: '@' Named 'NL'
Def: Deco* 'async'? 'def' id [TParams? (Params ('->' Test)? ':' Block
Class: Deco* 'class' id [TParams? (Args? ':' Block
TParams: TParam (',' TParam)* ','?
TParam: ('*' | '**')? id (':' Test)? ('=' Stars)?
Match: 'match' Subject ':' 'NL' ⟦Cases
Subject: StarNamed (',' StarNamed)* ','?
Cases: Case+
Case: 'case' Patterns ('if' Named)? ':' Block
Patterns: AsPat (',' AsPat)* ','?
AsPat: OrPat ('as' id)? | '*' id
OrPat: Pat ('|' Pat)*
Pat: '-'? num (('+' | '-') num)? | Strs | 'None' | 'True' | 'False' | id ('.' id)* (PatArgs? | (PatGroup | [PatGroup | {PatMap
PatGroup: ( AsPat (',' AsPat)* ','?)?
PatArgs: ( PatArg (',' PatArg)* ','?)?
PatArg: AsPat | id '=' AsPat
PatMap: ( PatPair (',' PatPair)* ','?)?
PatPair: ('-'? num | Strs | 'None' | 'True' | 'False' | id ('.' id)+) ':' AsPat | '**' id
Params: ( Plist ','?)?
Plist: Param (',' ( Param | '/'))* (',' StarParams)? | StarParams
StarParams: ('*' id (':' ( Test | '*' Test))? | '*') (',' Param)* (',' KwParam)? | KwParam
KwParam: '**' id (':' Test)?
Param: id (':' Test)? ('=' Test)?
Small: Stars | Assign | 'pass' | 'break' | 'continue' | 'del' Targets | 'return' Stars? | 'raise' ( Test ('from' Test)?)? | 'global' id (',' id)* | 'nonlocal' id (',' id)* | 'assert' Test (',' Test)? | Import | Yield | 'type' id [TParams? '=' Test
Import: 'import' Dotted ('as' id)? (',' Dotted ('as' id)?)* | 'from' (('.' | '...')* Dotted | ('.' | '...')+) 'import' ('*' | Names | (NamesC)
Dotted: id ('.' id)*
Names: id ('as' id)? (',' id ('as' id)?)*
NamesC: Names ','?
Assign: ( Targets '=')+ ( Stars | Yield) | Single AugOp ( Stars | Yield) | ( Single | (Single) ':' Test ('=' ( Stars | Yield))?
AugOp: '+=' | '-=' | '*=' | '/=' | '//=' | '%=' | '@=' | '&=' | '|=' | '^=' | '>>=' | '<<=' | '**='
Single: id | Prim Place
Target: Single | (TargetsC | [TargetsC
TargetsC: Targets?
Targets: '*'? Target (',' '*'? Target)* ','?
Prim: Atom Trailer* | 'await' Atom Trailer*
Place: '.' id | [Subs
Trailer: '.' id | [Subs | (Args
Yield: 'yield' 'from' Test | 'yield' Stars?
Stars: StarTest (',' StarTest)* ','?
StarTest: Test | '*' Bin
StarNamed: Named | '*' Bin
Named: id ':=' Test | Test
Test: Or ('if' Or 'else' Test)? | 'lambda' Lparams? ':' Test
Lparams: Lparam (',' ( Lparam | '/' | '*'))* ','? | '*' (',' Lparam)+ ','?
Lparam: ('*' | '**')? id ('=' Test)?
Or: Not (('and' | 'or') Not)*
Not: 'not'* Comp
Comp: Bin ( CompOp Bin)*
CompOp: '<' | '>' | '==' | '>=' | '<=' | '!=' | 'in' | 'not' 'in' | 'is' | 'is' 'not'
Bin: Unary ( BinOp Unary)*
BinOp: '+' | '-' | '*' | '/' | '//' | '%' | '@' | '**' | '<<' | '>>' | '&' | '|' | '^'
Unary: ('+' | '-' | '~')* Prim
Atom: id | num | Strs | '...' | 'None' | 'True' | 'False' | (Paren | [List | {Braces
Strs: str+
Paren: ( StarNamed (',' StarNamed)* ','?)? | Named CompFor | Yield
List: ( StarNamed (',' StarNamed)* ','?)? | Named CompFor
Braces: ( Pair (',' Pair)* ','?)? | Test ':' Test CompFor | StarNamed (',' StarNamed)* ','? | Named CompFor
Pair: Test ':' Test | '**' Bin
CompFor: ('async'? 'for' Targets 'in' Or ('if' ( Or | Named))*)+
Args: ( Arg (',' Arg)* ','?)? | Named CompFor
Arg: Named | id '=' Test | ('*' | '**') Test
Subs: Sub (',' Sub)* ','?
Sub: Test? ':' Test? (':' Test?)? | StarNamed
Piece: Stars '='? | Yield '='?
"""
JSON_ = r"""
File: Value
Value: str | num | 'true' | 'false' | 'null' | [Array | {Object
Array: ( Value (',' Value)*)?
Object: (str ':' Value (',' str ':' Value)*)?
"""

_RESERVED = frozenset(
    "break case catch class const continue debugger default delete do else enum export extends false finally for function if import in instanceof new null return super switch this throw true try typeof var void while with".split()
)
_STRICT = frozenset("implements interface let package private protected public static yield await".split())
_KEYWORDS = frozenset(
    "False None True and as assert async await break class continue def del elif else except finally for from global if import in is lambda nonlocal not or pass raise return try while with yield".split()
)


def _of_script(tok: str) -> frozenset:
    if tok in _RESERVED:
        return frozenset((tok, "name"))
    if tok in _STRICT:
        return frozenset((tok, "name", "id")) if tok not in ("let", "yield", "await", "static", "interface") else frozenset((tok, "name"))
    if tok == "#name":
        return frozenset(("name", "id"))
    if re.match(r"[A-Za-z_$]", tok) and tok not in ("num", "str", "tpl", "re", "bad", "NL"):
        return frozenset((tok, "name", "id"))
    return frozenset((tok,))


def _of_python(tok: str) -> frozenset:
    if tok in ("match", "case", "type", "_"):
        return frozenset((tok, "id"))
    return frozenset((tok,))


_PLAIN_SCRIPT = frozenset("BPattern BObj AsRef Obj Imports Exports ObjPattern Expr ForHead Catch Pattern Params Args Elements Enum TParams Tuple TIndex IndexSig Mapped Type Assign".split())
_PARSERS: dict[str, Parser] = {}


def parser(language: str) -> Parser:
    if language not in _PARSERS:
        if language == "python":
            _PARSERS[language] = Parser(Grammar(PYTHON), _of_python, frozenset())
        elif language == "json":
            _PARSERS[language] = Parser(Grammar(JSON_), lambda t: frozenset((t,)), frozenset())
        else:
            _PARSERS[language] = Parser(Grammar(SCRIPT + (TYPES if language == "typescript" else "")), _of_script, _PLAIN_SCRIPT)
    p = _PARSERS[language]
    p.fresh()
    return p


@dataclass
class Repair:
    """cost: edits; places: lines of the edits; at_end: all of them at the end of the file."""

    cost: int = 0
    places: list[int] = field(default_factory=list)
    at_end: bool = True
    most: int | None = None  # what is looked for: whether there are more edits than that; None: how many there are

    @property
    def done(self) -> bool:
        return self.most is not None and self.cost > self.most

    @property
    def room(self) -> int | None:
        return None if self.most is None else max(0, self.most - self.cost)

    def add(self, n: int, line: int, at_end: bool = False) -> None:
        if n:
            self.cost += n
            self.places.append(line)
            self.at_end &= at_end


# ---- tokens: (class or group, line, line end before)

_NUM_JS = re.compile(r"0[xX][0-9a-fA-F](?:_?[0-9a-fA-F])*n?|0[oO][0-7](?:_?[0-7])*n?|0[bB][01](?:_?[01])*n?|(?:(?:0|[1-9](?:_?\d)*)(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?n?")
_PUNCT_JS = re.compile(r">>>=|\.\.\.|===|!==|\*\*=|<<=|&&=|\|\|=|\?\?=|=>|==|!=|<=|>=|&&|\|\||\?\?|\?\.(?!\d)|\+\+|--|\+=|-=|\*=|/=|%=|&=|\|=|\^=|<<|\*\*|[{}()\[\];,<>+\-*/%&|^!~?:=.@#]")
_ID = re.compile(r"[^\W\d][\w]*")
_ID_JS = re.compile(r"(?:[^\W\d]|\$|\\u[0-9a-fA-F]{4}|\\u\{[0-9a-fA-F]+\})(?:\w|\$|\\u[0-9a-fA-F]{4}|\\u\{[0-9a-fA-F]+\}|[‌‍])*")
_STR_JS = re.compile(r"\"(?:\\(?:\r\n|[\s\S])|[^\"\\\n\r])*\"|'(?:\\(?:\r\n|[\s\S])|[^'\\\n\r])*'")
_RE_JS = re.compile(r"/(?![*/])(?:\\[^\n\r]|\[(?:\\[^\n\r]|[^\]\\\n\r])*\]|[^/\\\n\r\[])+/[A-Za-z]*")
_VALUE_END = frozenset((")", "]", "}", "num", "str", "tpl", "re", "this", "super", "null", "true", "false", "++", "--"))
_CLOSER = {"(": ")", "[": "]", "{": "}"}


def _ends_value(tok) -> bool:
    return isinstance(tok, tuple) or tok in _VALUE_END or (tok not in _RESERVED and _ID_JS.match(tok) is not None)


_NO_END = frozenset("= => + - * / % & | ^ ! ~ ? : , . ?. ( [ { && || ?? == != === !== < <= >= << ** += -= *= /= %= &= |= ^= **= <<= &&= ||= ??= ... in of instanceof typeof void delete new extends implements case else do try finally import from const let var function class async export default @ ;".split())
_NO_START = frozenset("= => + - * / % & | ^ ? : , . ?. ) ] } && || ?? == != === !== < > <= >= << ** += -= *= /= %= &= |= ^= **= <<= &&= ||= ??= ; in instanceof NL".split())


def lex_script(text: str, p: Parser, fix: Repair, base: int = 1, inner: bool = False) -> list[tuple]:
    """Tokens with groups, a line end token ('NL') where a line end may end a statement. Faults go to `fix`."""
    at, n, line = 0, len(text), base
    stack: list[tuple[str, int, list]] = []
    now: list[tuple] = []
    newline = False
    if text.startswith("﻿"):
        at = 1
    if text.startswith("#!", at):
        at = text.find("\n", at) if "\n" in text[at:] else n

    def put(tok) -> None:
        nonlocal newline
        if newline and now:
            prev = now[-1][0]
            typed = prev == "void" and len(now) > 1 and now[-2][0] in (":", "=>", "|", "&")  # a type, not an operator
            if (typed or not (isinstance(prev, str) and prev in _NO_END)) and not (isinstance(tok, str) and tok in _NO_START) and not (isinstance(tok, tuple) and tok[0] in "(["):
                now.append(("NL", line))
        newline = False
        now.append((tok, line))

    def close(bracket: str, shut: int) -> None:
        nonlocal now, newline
        b, opened, outer = stack.pop()
        # a group's last statement may end without a mark
        if b == "{" and now and now[-1][0] not in (";", "NL"):
            now.append(("NL", line))
        seq = tuple(t for t, _ in now if b == "{" or t != "NL")
        shape = p.intern(seq)
        lines.setdefault(shape, [x for _, x in now])
        now = outer
        group = (b, shape)
        now.append((group, opened))

    lines: dict[int, list[int]] = {}
    while at < n:
        c = text[at]
        if c == "\n" or (c == "\r") or c in "  ":
            if c == "\r" and text.startswith("\r\n", at):
                at += 1
            line, at, newline = line + 1, at + 1, True
            continue
        if c.isspace() or c == "﻿":
            at += 1
            continue
        if text.startswith("//", at):
            m = re.compile(r"[^\n\r  ]*").match(text, at)
            at = m.end()
            continue
        if text.startswith("/*", at):
            e = text.find("*/", at + 2)
            if e < 0:
                fix.add(1, line, True)
                e = n
            if "\n" in text[at:e]:
                line += text.count("\n", at, e)
                newline = True
            at = e + 2
            continue
        m = _ID_JS.match(text, at)
        if m:
            put(m.group() if (m.group() in _INTERESTING) else "x")
            at = m.end()
            continue
        if c.isdigit() or (c == "." and at + 1 < n and text[at + 1].isdigit()):
            m = _NUM_JS.match(text, at)
            e = m.end()
            rest = re.compile(r"[\w$]+").match(text, e)
            if rest or (c == "0" and m.group() == "0" and e < n and text[e].isdigit()):
                put("bad")
                e = rest.end() if rest else e + 1
            else:
                put("num")
            at = e
            continue
        if c in "\"'":
            m = _STR_JS.match(text, at)
            if m:
                put("str")
                line += m.group().count("\n")
                at = m.end()
            else:
                e = re.compile(r"[^\n\r]*").match(text, at).end()
                put("str")
                fix.add(1, line, text[e:].strip() == "")
                at = e
            continue
        if c == "`":
            e, parts, ok = _template(text, at)
            put("tpl")
            for a, b in parts:
                sub = Repair(most=fix.room)
                seq = lex_script(text[a:b], p, sub, line + text.count("\n", at, a), True)
                fix.add(sub.cost + (p.cost("Expr", tuple(t for t, _ in seq if t != "NL"), sub.room) if seq else 1), line)
            if not ok:
                fix.add(1, line, True)
            line += text.count("\n", at, e)
            at = e
            continue
        if c == "/" and not (now and _ends_value(now[-1][0])):
            m = _RE_JS.match(text, at)
            if m:
                put("re")
                at = m.end()
                continue
        if c == "#" and (m := _ID_JS.match(text, at + 1)):
            put("#name")
            at = m.end()
            continue
        m = _PUNCT_JS.match(text, at)
        if not m:
            put("bad")
            at += 1
            continue
        s = m.group()
        at = m.end()
        if s in "([{":
            if newline and now:
                prev = now[-1][0]
                if s == "{" and not (isinstance(prev, str) and prev in _NO_END) and not (isinstance(prev, tuple) and prev[0] == "("):
                    now.append(("NL", line))
            newline = False
            stack.append((s, line, now))
            now = []
        elif s in ")]}":
            newline = False
            if stack and _CLOSER[stack[-1][0]] == s:
                close(s, line)
            elif any(_CLOSER[b] == s for b, _, _ in stack):
                while _CLOSER[stack[-1][0]] != s:  # what is open inside was not closed
                    fix.add(1, line)
                    close(s, line)
                close(s, line)
            else:
                fix.add(1, line)
        else:
            put(s)
    while stack:
        fix.add(1, line, True)
        close("", line)
    if not inner and now and now[-1][0] not in (";", "NL"):
        now.append(("NL", line))
    return now


def _template(text: str, at: int) -> tuple[int, list[tuple[int, int]], bool]:
    """(end, spans of substitutions, closed) of the template at `at`."""
    i, n, parts = at + 1, len(text), []
    while i < n:
        c = text[i]
        if c == "\\":
            i += 2
        elif c == "`":
            return i + 1, parts, True
        elif text.startswith("${", i):
            j, depth = i + 2, 1
            while j < n and depth:
                d = text[j]
                if d in "\"'" and (m := _STR_JS.match(text, j)):
                    j = m.end()
                    continue
                if d == "`":
                    j = _template(text, j)[0]
                    continue
                depth += (d == "{") - (d == "}")
                j += 1
            if depth:
                return n, parts, False
            parts.append((i + 2, j - 1))
            i = j
        else:
            i += 1
    return n, parts, False


_INTERESTING = _RESERVED | _STRICT | frozenset("async of get set as from type declare abstract readonly override namespace module global enum is asserts infer keyof unique satisfies accessor out assert".split())


def _statements(tokens: list[tuple]) -> list[list[tuple]]:
    """Parts that end with a semicolon outside brackets and don't go on with else; the rest stays together."""
    out, now = [], []
    for i, t in enumerate(tokens):
        now.append(t)
        if t[0] == ";":
            j = i + 1
            while j < len(tokens) and tokens[j][0] == "NL":
                j += 1
            if j < len(tokens) and tokens[j][0] in ("else", "while", "catch", "finally"):
                continue
            out.append(now)
            now = []
    return [*out, now] if now else out


def repair_script(text: str, language: str, most: int | None = None) -> Repair:
    p, fix = parser(language), Repair(most=most)
    tokens = lex_script(text, p, fix)
    last = tokens[-1][1] if tokens else 1
    for part in _statements(tokens):
        seq = tuple(t for t, _ in part)
        if p.parses("Module", seq):
            continue
        if fix.done:
            break
        _locate(p, "Module", seq, part, fix, last)
    return fix


def _locate(p: Parser, nt: str, seq: tuple, part: list[tuple], fix: Repair, last: int) -> None:
    line = part[max(0, p.reach(nt, seq))][1]
    n = p.cost(nt, seq, fix.room)
    fix.add(n, line, line >= last)


# ---- Python

_NUM_PY = re.compile(r"0[xX](?:_?[0-9a-fA-F])+|0[oO](?:_?[0-7])+|0[bB](?:_?[01])+|(?:\d(?:_?\d)*)?\.\d(?:_?\d)*(?:[eE][+-]?\d(?:_?\d)*)?[jJ]?|\d(?:_?\d)*\.?(?:[eE][+-]?\d(?:_?\d)*)?[jJ]?")
_PUNCT_PY = re.compile(r"\*\*=|//=|>>=|<<=|\.\.\.|:=|->|==|!=|<=|>=|\+=|-=|\*=|/=|%=|@=|&=|\|=|\^=|//|\*\*|<<|>>|[{}()\[\],:;.=+\-*/%@&|^~<>]")
_PREFIX = re.compile(r"(?i)(?:r|u|b|br|rb|f|fr|rf)?(?=['\"])")


def _string_py(text: str, at: int) -> tuple[int, bool, str, str] | None:
    """(end, closed, prefix, content) of the literal at `at`."""
    m = _PREFIX.match(text, at)
    if not m:
        return None
    i = m.end()
    q = text[i]
    triple = text.startswith(q * 3, i)
    quote = q * 3 if triple else q
    j = i + len(quote)
    n = len(text)
    formatted = "f" in m.group().lower()
    depth = 0
    while j < n:
        c = text[j]
        if c == "\\" and not (formatted and depth):
            j += 2
            continue
        if formatted and c in "{}":
            if c == "{" and depth == 0 and text.startswith("{{", j):
                j += 2
                continue
            depth = depth + 1 if c == "{" else max(0, depth - 1)
        elif formatted and depth and c in "'\"" and not text.startswith(quote, j):
            inner = _string_py(text, j)
            if inner and inner[1]:
                j = inner[0]
                continue
        elif text.startswith(quote, j):
            if formatted and depth:
                inner = _string_py(text, j)
                stop = text.find("\n", j)
                if inner and inner[1] and not triple and (stop < 0 or inner[0] <= stop) and _closes_later(text, inner[0], quote):
                    j = inner[0]
                    continue
            return j + len(quote), True, m.group(), text[i + len(quote) : j]
        if c == "\n" and not triple:
            return j, False, m.group(), text[i + len(quote) : j]
        j += 1
    return n, False, m.group(), text[i + len(quote) :]


def _closes_later(text: str, at: int, quote: str) -> bool:
    stop = text.find("\n", at)
    rest = text[at : stop if stop >= 0 else len(text)]
    return "}" in rest and quote in rest[rest.find("}") :]


def _fields(content: str) -> tuple[list[str], bool]:
    """Expressions in the replacement fields of a formatted string, and whether its braces are in order."""
    out, i, n = [], 0, len(content)
    while i < n:
        c = content[i]
        if c == "{":
            if content.startswith("{{", i):
                i += 2
                continue
            depth, j = 1, i + 1
            cut = None
            level = 0
            while j < n and depth:
                d = content[j]
                if d in "'\"" and cut is None:
                    s = _string_py(content, j)
                    if s and s[1]:
                        j = s[0]
                        continue
                if cut is None and d in "([":
                    level += 1
                elif cut is None and d in ")]":
                    level -= 1
                elif d == "{":
                    depth += 1
                elif d == "}":
                    depth -= 1
                elif cut is None and depth == 1 and level == 0 and (d == ":" or (d == "!" and content[j + 1 : j + 2] != "=")):
                    cut = j
                j += 1
            if depth:
                return out, False
            out.append(content[i + 1 : cut if cut is not None else j - 1])
            i = j
        elif c == "}":
            if not content.startswith("}}", i):
                return out, False
            i += 2
        else:
            i += 1
    return out, True


def lex_python(text: str, p: Parser, fix: Repair, base: int = 1, inner: bool = False) -> list[tuple]:
    """Tokens with bracket groups and, as groups of their own, indented blocks. Each statement line ends with 'NL'."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if text.startswith("﻿"):
        text = text[1:]
    at, n, line = 0, len(text), base
    now: list[tuple] = []
    stack: list[tuple[str, int, list]] = []
    indents = [0]
    blocks: list[tuple[int, list]] = []
    fresh = not inner

    def shut(bracket: str, opened: int, outer: list) -> None:
        nonlocal now
        shape = p.intern(tuple(t for t, _ in now))
        now = outer
        now.append(((bracket, shape), opened))

    def dedent() -> None:
        indents.pop()
        opened, outer = blocks.pop()
        shut("⟦", opened, outer)

    while at < n:
        if fresh and not stack:
            m = re.compile(r"[ \t\f]*").match(text, at)
            lead = m.group().rpartition("\f")[2]
            e = m.end()
            if e >= n:
                at = e
                break
            if text[e] in "#\n":
                e2 = text.find("\n", e)
                at = n if e2 < 0 else e2 + 1
                line += e2 >= 0
                continue
            width = len(lead.expandtabs(8))
            if width > indents[-1]:
                if now and now[-1][0] == "NL" and len(now) > 1 and now[-2][0] == ":":
                    indents.append(width)
                    blocks.append((line, now))
                    now = []
                else:
                    fix.add(1, line)
                    indents.append(width)
                    blocks.append((line, now))
                    now = []
            else:
                while width < indents[-1]:
                    dedent()
                if width != indents[-1]:
                    fix.add(1, line)
            fresh = False
            at = e
            continue
        c = text[at]
        if c == "\n":
            if not stack and not inner:
                if now and now[-1][0] != "NL" or (now == [] and blocks):
                    now.append(("NL", line))
                fresh = True
            line, at = line + 1, at + 1
            continue
        if c in " \t\f":
            at += 1
            continue
        if c == "\\" and text.startswith("\n", at + 1):
            line, at = line + 1, at + 2
            continue
        if c == "#":
            e = text.find("\n", at)
            at = n if e < 0 else e
            continue
        s = _string_py(text, at)
        if s:
            end, closed, prefix, content = s
            now.append(("str", line))
            if not closed:
                fix.add(1, line, text[end:].strip() == "")
            elif "f" in prefix.lower() and "{" in content + "}" and ("{" in content or "}" in content):
                parts, order = _fields(content)
                if not order:
                    fix.add(1, line)
                for x in parts:
                    sub = Repair(most=fix.room)
                    seq = tuple(t for t, _ in lex_python(x.strip(), p, sub, line, True))
                    fix.add(sub.cost + (p.cost("Piece", seq, sub.room) if seq else 1), line)
            line += text.count("\n", at, end)
            at = end
            continue
        m = _ID.match(text, at)
        if m:
            w = m.group()
            now.append((w if w in _KEYWORDS or w in ("match", "case", "type") else "id", line))
            at = m.end()
            continue
        if c.isdigit() or (c == "." and at + 1 < n and text[at + 1].isdigit()):
            m = _NUM_PY.match(text, at)
            e = m.end()
            w = m.group()
            bad = re.match(r"0\d", w.replace("_", "")) and re.fullmatch(r"[\d_]+", w) and w.replace("_", "").strip("0")
            rest = re.compile(r"\w+").match(text, e)
            if rest and rest.group() not in _KEYWORDS:
                bad = True
                e = rest.end()
            now.append(("bad" if bad else "num", line))
            at = e
            continue
        m = _PUNCT_PY.match(text, at)
        if not m:
            now.append(("bad", line))
            at += 1
            continue
        s = m.group()
        at = m.end()
        if s in "([{":
            stack.append((s, line, now))
            now = []
        elif s in ")]}":
            if stack and _CLOSER[stack[-1][0]] == s:
                b, opened, outer = stack.pop()
                shut(b, opened, outer)
            elif any(_CLOSER[b] == s for b, _, _ in stack):
                while _CLOSER[stack[-1][0]] != s:
                    fix.add(1, line)
                    b, opened, outer = stack.pop()
                    shut(b, opened, outer)
                b, opened, outer = stack.pop()
                shut(b, opened, outer)
            else:
                fix.add(1, line)
        else:
            now.append((s, line))
    while stack:
        fix.add(1, line, True)
        b, opened, outer = stack.pop()
        shut(b, opened, outer)
    if not inner:
        if now and now[-1][0] != "NL" and not (isinstance(now[-1][0], tuple) and now[-1][0][0] == "⟦"):
            now.append(("NL", line))
        while blocks:
            dedent()
    return now


def _lines_python(tokens: list[tuple]) -> list[list[tuple]]:
    """Statements: a logical line with its block, joined with the clauses that go with it and with decorators before."""
    out: list[list[tuple]] = []
    now: list[tuple] = []
    for i, t in enumerate(tokens):
        now.append(t)
        if t[0] == "NL" or (isinstance(t[0], tuple) and t[0][0] == "⟦"):
            nxt = tokens[i + 1][0] if i + 1 < len(tokens) else None
            if isinstance(nxt, tuple) and nxt[0] == "⟦":
                continue
            if nxt in ("elif", "else", "except", "finally") or (now[0][0] == "@" and not any(x[0] in ("def", "class") for x in now)):
                continue
            out.append(now)
            now = []
    return [*out, now] if now else out


def repair_python(text: str, most: int | None = None) -> Repair:
    p, fix = parser("python"), Repair(most=most)
    tokens = lex_python(text, p, fix)
    last = tokens[-1][1] if tokens else 1
    for part in _lines_python(tokens):
        seq = tuple(t for t, _ in part)
        if p.parses("Stmts", seq):
            continue
        if fix.done:
            break
        _locate(p, "Stmts", seq, part, fix, last)
    return fix


# ---- JSON

_JSON = re.compile(r"[ \t\n\r]+|(?P<s>\"(?:\\(?:[\"\\/bfnrt]|u[0-9a-fA-F]{4})|[^\"\\\x00-\x1f])*\")|(?P<n>-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.]))|(?P<w>true|false|null)\b|(?P<p>[{}\[\],:])|(?P<q>\"(?:\\.|[^\"\\\n])*\"?)|(?P<x>[^\s{}\[\],:\"]+|.)", re.S)


def repair_json(text: str, most: int | None = None) -> Repair:
    p, fix = parser("json"), Repair(most=most)
    now: list[tuple] = []
    stack: list[tuple[str, int, list]] = []
    line = 1

    def shut() -> None:
        nonlocal now
        b, opened, outer = stack.pop()
        seq = tuple(t for t, _ in now)
        # a long array or object of sound members is checked member by member, which keeps shapes short
        shape = p.intern(_folded(b, seq, p))
        now = outer
        now.append(((b, shape), opened))

    for m in _JSON.finditer(text):
        kind, s = m.lastgroup, m.group()
        if kind is None:
            line += s.count("\n")
            continue
        if kind == "p":
            if s in "[{":
                stack.append((s, line, now))
                now = []
            elif s in "]}":
                if any(_CLOSER[b] == s for b, _, _ in stack):
                    while _CLOSER[stack[-1][0]] != s:
                        fix.add(1, line)
                        shut()
                    shut()
                else:
                    fix.add(1, line)
            else:
                now.append((s, line))
        else:
            now.append(({"s": "str", "n": "num", "w": s}.get(kind, "bad"), line))
        line += s.count("\n")
    while stack:
        fix.add(1, line, True)
        shut()
    seq = tuple(t for t, _ in now)
    if not fix.done and not p.parses("File", seq):
        if not seq:
            fix.add(1, line, True)
        else:
            _locate(p, "File", seq, now, fix, line)
    return fix


def _folded(bracket: str, seq: tuple, p: Parser) -> tuple:
    """The same contents with sound members left out that stand between sound ones: derivable, or so by one edit, exactly if the
    whole is. A group costs no more than two edits, so its cost is the same."""
    if len(seq) <= 24 or bracket not in "[{":
        return seq
    parts: list[tuple] = [()]
    for t in seq:
        if t == ",":
            parts.append(())
        else:
            parts[-1] = (*parts[-1], t)
    nt = "Array" if bracket == "[" else "Object"
    sound = [bool(x) and p.parses(nt, x) for x in parts]
    kept = [x for i, x in enumerate(parts) if i in (0, len(parts) - 1) or not all(sound[i - 1 : i + 2])]
    out: list = []
    for i, x in enumerate(kept):
        out += ([","] if i else []) + list(x)
    return tuple(out)


# ---- verdicts

_MARKER = re.compile(r"^(?:<{7}(?: .*)?|={7}|>{7}(?: .*)?|\|{7}(?: .*)?)$")


def repair(text: str, language: str, most: int | None = None) -> Repair:
    """The repair of a text of least cost; if it costs more than `most`, only that it does is certain."""
    return repair_python(text, most) if language == "python" else repair_json(text, most) if language == "json" else repair_script(text, language, most)


def confirmed(text: str, language: str) -> bool:
    """The exact parser's word on a flag, where there is one."""
    try:
        if language == "python":
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(text.removeprefix("﻿"))
            return False
        if language == "json":
            json.loads(text, parse_constant=_no_constant)
            return False
    except (ValueError, SyntaxError, RecursionError, MemoryError):
        return True
    return True


def _no_constant(name: str):
    raise ValueError(name)


def invalid(text: str | None, language: str | None) -> bool:
    """Whether the least repair costs anything, without looking for it."""
    if text is None or language not in LANGUAGES or (language != "json" and not text.strip("﻿ \t\r\n")):
        return False
    return confirmed(text, language) and repair(text, language, 0).cost > 0


def check(text: str | None, language: str | None) -> tuple[int, str | None, int | None]:
    """(cost, cause, first line of an edit); cost 0 and no cause for valid files."""
    if not invalid(text, language):
        return 0, None, None
    fix = repair(text, language)
    lines = text.split("\n")
    first = min(fix.places)
    if any(_MARKER.match(lines[i].rstrip("\r")) for k in fix.places for i in range(max(0, k - 2), min(len(lines), k + 1))) and any(x.startswith(("<<<<<<<", ">>>>>>>")) for x in lines):
        return fix.cost, "conflict", first
    if fix.at_end:
        return fix.cost, "truncation", first
    if fix.cost >= 3:
        for other in LANGUAGES:
            if other != language and not (language == "javascript" and other == "json") and repair(text, other, fix.cost // 3).cost * 3 <= fix.cost:
                return fix.cost, "mismatch", first
    return fix.cost, "mismatch" if fix.cost >= CAP else "damage", first


def checked(files: DataFrame) -> DataFrame:
    """(file_id, repo_full_name, language, edits, cause, line): every file, its language as checked, and its repair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for i, repo, path, label, code in p[["file_id", "repo_full_name", "file_path", "language", "code"]].itertuples(index=False):
                lang = language_of(label if isinstance(label, str) else None, path)
                cost, cause, line = check(code if isinstance(code, str) else None, lang)
                out.append((i, repo, lang, cost, cause, line))
            r = pd.DataFrame(out, columns=["file_id", "repo_full_name", "language", "edits", "cause", "line"])
            yield r.astype({"line": "Int32", "edits": "int32"})

    return files.select("file_id", "repo_full_name", "file_path", "language", "code").mapInPandas(
        run, "file_id bigint, repo_full_name string, language string, edits int, cause string, line int"
    )


def flagged(files: DataFrame) -> DataFrame:
    """(file_id): the files with a repair, for which it need not be known."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            rows = p[["file_id", "file_path", "language", "code"]].itertuples(index=False)
            bad = [i for i, path, label, code in rows if invalid(code if isinstance(code, str) else None, language_of(label if isinstance(label, str) else None, path))]
            yield pd.DataFrame({"file_id": pd.Series(bad, dtype="int64")})

    return files.select("file_id", "file_path", "language", "code").mapInPandas(run, "file_id bigint")


def rates(result: DataFrame) -> DataFrame:
    """Per repository and language: files, files that don't parse, their rate, and the numbers by cause."""
    of = lambda c: F.count_if(F.col("cause") == c).alias(c)
    return result.groupBy("repo_full_name", "language").agg(
        F.count("*").alias("files"), F.count_if(F.col("edits") > 0).alias("invalid"), F.round(F.count_if(F.col("edits") > 0) / F.count("*"), 6).alias("rate"), of("truncation"), of("conflict"), of("mismatch"), of("damage")
    )
