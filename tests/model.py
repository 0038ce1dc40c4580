"""What the extractor must find, worked out another way: by climbing parents in plain Python."""

from __future__ import annotations

import ast

LOOP = (ast.For, ast.AsyncFor, ast.While)
FLOW = (ast.If, *LOOP, ast.With, ast.AsyncWith, ast.Try, ast.ExceptHandler)
SCOPE = (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)


def spot(node):
    return (type(node).__name__, getattr(node, "lineno", None), getattr(node, "col_offset", None))


class Model:
    def __init__(self, source: str) -> None:
        self.tree = ast.parse(source, type_comments=True)
        self.up = {}  # statement or other positioned node -> (parent, field, list)
        for parent in ast.walk(self.tree):
            for field, value in ast.iter_fields(parent):
                for child in value if isinstance(value, list) else [value]:
                    if isinstance(child, ast.AST) and not isinstance(child, (ast.expr_context, ast.operator, ast.unaryop, ast.boolop, ast.cmpop)):
                        self.up[child] = (parent, field, value)

    # -- control flow
    def visible(self, node) -> bool:
        while True:
            parent, field, _ = self.up[node]
            if isinstance(parent, SCOPE):
                return field == "body"
            if not isinstance(parent, FLOW):
                return False
            node = parent

    def follow(self, node):
        parent, field, block = self.up[node]
        if not isinstance(node, ast.ExceptHandler):
            at = block.index(node)
            if at + 1 < len(block):
                return block[at + 1]
        if isinstance(parent, SCOPE):
            return None
        if isinstance(parent, LOOP) and field == "body":
            return parent
        if isinstance(parent, ast.ExceptHandler):
            return self.follow(parent)
        if isinstance(parent, ast.Try) and field != "finalbody":
            rest = {"body": parent.orelse or parent.finalbody}.get(field, parent.finalbody)
            if rest:
                return rest[0]
        return self.follow(parent)

    def loop_around(self, node):
        while not isinstance(node, SCOPE):
            parent, field, _ = self.up[node]
            if isinstance(parent, LOOP) and field == "body":
                return parent
            node = parent
        return None

    def cfg(self) -> list:
        out = []
        for node in self.up:
            if not isinstance(node, (ast.stmt, ast.ExceptHandler)) or not self.visible(node):
                continue
            go = []
            if isinstance(node, ast.If):
                go = [("TRUE", node.body[0]), ("FALSE", node.orelse[0] if node.orelse else self.follow(node))]
            elif isinstance(node, LOOP):
                go = [("LOOP_BODY", node.body[0]), ("LOOP_EXIT", node.orelse[0] if node.orelse else self.follow(node))]
            elif isinstance(node, (ast.With, ast.AsyncWith)):
                go = [("ENTER", node.body[0])]
            elif isinstance(node, ast.Try):
                go = [("TRY", node.body[0])] + [("EXCEPT", h) for h in node.handlers]
            elif isinstance(node, ast.ExceptHandler):
                go = [("HANDLE", node.body[0])]
            elif isinstance(node, ast.Break):
                loop = self.loop_around(node)
                go = [("BREAK", loop and self.follow(loop))]
            elif isinstance(node, ast.Continue):
                go = [("CONTINUE", self.loop_around(node))]
            elif not isinstance(node, (ast.Return, ast.Raise)):
                go = [("NEXT", self.follow(node))]
            out += [(spot(node), label, spot(to)) for label, to in go if to is not None]
        return out

    # -- data flow
    def statement_of(self, node):
        """Statement an expression belongs to; None below a lambda."""
        while not isinstance(node, ast.stmt):
            node = self.up[node][0]
            if isinstance(node, (ast.Lambda, ast.Module)):
                return None
        return node

    def scope_of(self, statement):
        """Scope that runs a statement; None inside handler and match-case bodies."""
        node = statement
        while True:
            parent, _, _ = self.up[node]
            if isinstance(parent, SCOPE):
                return parent
            if isinstance(parent, (ast.ExceptHandler, ast.match_case)):
                return None
            node = parent

    def dfg(self) -> list:
        uses, defs = [], []  # (scope, name, order, node, anchor)
        for node in self.up:
            if isinstance(node, ast.Name):
                statement = self.statement_of(node)
                scope = statement and self.scope_of(statement)
                if scope is None:
                    continue
                at = (statement.lineno, statement.col_offset)
                if isinstance(node.ctx, ast.Load):
                    uses.append((scope, node.id, at, node, node.id))
                elif isinstance(node.ctx, ast.Store):
                    if isinstance(statement, ast.AugAssign) and statement.target is node:
                        uses.append((scope, node.id, at, node, f"aug:{node.id}"))
                    defs.append((scope, node.id, (*at, 0, node.lineno, node.col_offset), node))
            elif isinstance(node, ast.stmt) and self.scope_of(node):
                names = []
                if isinstance(node, SCOPE):
                    names = [node.name]
                elif isinstance(node, (ast.Import, ast.ImportFrom)):
                    names = [a.asname or a.name.partition(".")[0] for a in node.names]
                defs += [(self.scope_of(node), n, (node.lineno, node.col_offset, 1, 0, 0), node) for n in names]
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                a = node.args
                listed = [*a.posonlyargs, *a.args, *a.kwonlyargs, *filter(None, (a.vararg, a.kwarg))]
                defs += [(node, arg.arg, (-1, 0, 0, i, 0), arg) for i, arg in enumerate(listed)]
        out = []
        for scope, name, at, node, anchor in uses:
            earlier = [(d[2], d[3]) for d in defs if d[0] is scope and d[1] == name and d[2][:2] < at]
            if earlier:
                out.append((spot(max(earlier, key=lambda e: e[0])[1]), anchor, spot(node)))
        return out

    # -- calls
    def scope_text(self, node) -> str:
        names = []
        while node in self.up:
            node = self.up[node][0]
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                names.append(node.name)
            elif isinstance(node, ast.Lambda):
                names.append(f"<lambda:{node.lineno}>")
        return ".".join(reversed(names))

    def name_of(self, node) -> str:
        if isinstance(node, ast.Name):
            return node.id
        if isinstance(node, ast.Subscript):
            return self.name_of(node.value)
        if isinstance(node, ast.Attribute):
            return ".".join(filter(None, (self.name_of(node.value), node.attr)))
        if isinstance(node, ast.Call):
            inner = self.name_of(node.func)
            return inner + "()" if inner else "<call-result>"
        return ""

    def calls(self) -> list:
        known: dict[str, list] = {}
        for node in self.up:
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                scope = self.scope_text(node)
                for name in {node.name, f"{scope}.{node.name}" if scope else node.name}:
                    known.setdefault(name, []).append(node)
        out = []
        for call in self.up:
            if not isinstance(call, ast.Call):
                continue
            target = self.name_of(call.func) or "<dynamic-call>"
            scope = self.scope_text(call)
            levels = scope.split(".") if scope else []
            tries = [target]
            if target.startswith(("self.", "cls.")):
                tries = [".".join([*levels[:-1], target.split(".", 1)[1]])] if len(levels) > 1 else []
            elif "." not in target:
                tries = [".".join([*levels[:n], target]) for n in range(len(levels), -1, -1)]
            tries.append(target.split(".")[-1])
            hit = next((known[t][0] for t in tries if len(known.get(t, ())) == 1), None)
            owner = call
            while not isinstance(owner, (ast.FunctionDef, ast.AsyncFunctionDef, ast.Lambda, ast.Module)):
                owner = self.up[owner][0]
            out.append((spot(owner), target, spot(call), spot(hit) if hit else ("ExternalSymbol", None, None)))
        return out
