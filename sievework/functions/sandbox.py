"""Running candidate code: a child process per call, killed at a wall-clock limit, with a memory limit and few names.

A ``Sandbox`` starts Python once and forks it for every call, so that a call costs milliseconds; the children share nothing
that one of them could change for another. Calls of plain arithmetic, which can change nothing (``plain_arithmetic``), share a
child by tens; where that doesn't end well, each is run again in a child of its own.
"""

from __future__ import annotations

import ast
import json
import select
import struct
import subprocess
import sys

#: What runs in the server, and from the end of its loop on in each child, at the top of the script as candidate code always ran.
#: Requests on its standard input: limits and the length of the JSON that follows; answers: a status, a number and the child's last line.
SERVER = r"""
import builtins, collections, decimal, fractions, functools, gc, itertools, json, math, cmath, os, re, resource, select, signal, statistics, struct, sys, time
from typing import Tuple, List, Dict, Optional, Union, Any
if sys.argv[1] == 'numpy':
    try:
        import numpy
    except Exception:
        pass
def taken_in(n):
    parts = []
    while n:
        got = os.read(0, min(n, 1 << 20))
        if not got: os._exit(0)
        parts.append(got); n -= len(got)
    return b''.join(parts)
def told(status, number, line=b''):
    out = memoryview(struct.pack('>cqq', status, number, len(line)) + line)
    while out:
        out = out[os.write(1, out):]
def outcome(pipe, pid, seconds):
    until, line = time.monotonic() + seconds, bytearray()
    while (left := until - time.monotonic()) > 0 and select.select([pipe], [], [], left)[0]:
        got = os.read(pipe, 1 << 16)
        if not got:
            while time.monotonic() < until:
                ended, status = os.waitpid(pid, os.WNOHANG)
                if ended: return b'E', os.waitstatus_to_exitcode(status), bytes(line)
                time.sleep(0.0002)
            break
        at = got.rfind(b'\n')
        if at >= 0: line.clear()
        line += got[at + 1:]
    for kill in (os.killpg, os.kill):
        try:
            kill(pid, signal.SIGKILL)
        except OSError:
            pass
    os.waitpid(pid, 0)
    return b'T', 0, b''
allowed = {'math', 'cmath', 'numpy', 'typing', 'functools', 'itertools', 'collections', 'fractions', 'decimal', 'statistics', 're'}
real = builtins.__import__
def guarded(name, g=None, l=None, fromlist=(), level=0):
    if g is not None and g.get('__name__') == 'candidate' and name.split('.')[0] not in allowed:
        raise ImportError(name + ' is not available')
    return real(name, g, l, fromlist, level)
names = dict(vars(builtins)); names['__import__'] = guarded
for taken in ('open', 'input', 'eval', 'exec', 'compile', 'breakpoint', 'exit', 'quit'):
    names.pop(taken, None)
def plain(v):
    if isinstance(v, complex): return {'re': v.real, 'im': v.imag}
    if hasattr(v, 'tolist'): return plain(v.tolist())
    if isinstance(v, (list, tuple)): return [plain(x) for x in v]
    if isinstance(v, dict): return {str(k): plain(x) for k, x in v.items()}
    if isinstance(v, float) and not math.isfinite(v): raise ValueError('the result is not finite')
    return v if v is None or isinstance(v, (bool, int, float, str)) else str(v)
def made(v, kind):
    try:
        if kind == 'complex':
            return complex(v['re'], v['im']) if isinstance(v, dict) else complex(*v) if isinstance(v, list) else complex(str(v).strip().strip('()').replace('i', 'j'))
        if kind in ('tuple', 'Tuple'):
            return tuple(v) if isinstance(v, list) else v
        if kind in ('ndarray', 'array'):
            import numpy
            return numpy.array(v, dtype=float)
    except Exception:
        pass
    return v
nothing = os.open(os.devnull, os.O_RDWR)
gc.collect(); gc.freeze()
while True:
    limit, seconds, size = struct.unpack('>qdq', taken_in(24))
    text = taken_in(size)
    up, down = os.pipe()
    try:
        pid = os.fork()
    except OSError as e:
        os.close(up); os.close(down)
        told(b'F', e.errno or 0)
        continue
    if not pid: break
    os.close(down)
    answer = outcome(up, pid, seconds)
    os.close(up)
    told(*answer)
os.setsid()
os.dup2(nothing, 0); os.dup2(down, 1); os.dup2(nothing, 2)
os.close(nothing); os.close(up); os.close(down)
resource.setrlimit(resource.RLIMIT_AS, (limit, limit))
resource.setrlimit(resource.RLIMIT_NPROC, (0, 0))
if 'numpy.random' in sys.modules: numpy.random.seed()
outs = []
for work in json.loads(text):
    scope = {'__name__': 'candidate', '__builtins__': names, 'math': math, 'cmath': cmath}
    if 'np' in work['code'] or 'numpy' in work['code']:
        try:
            import numpy
            scope.update(np=numpy, numpy=numpy)
        except Exception:
            pass
    scope.update(Tuple=Tuple, List=List, Dict=Dict, Optional=Optional, Union=Union, Any=Any)
    out = {'error': None, 'results': []}
    try:
        before = set(scope)
        exec(compile(work['code'], 'candidate', 'exec'), scope)
        found = [v for k, v in scope.items() if k not in before and getattr(v, '__code__', None) and v.__code__.co_filename == 'candidate']
        if not found:
            out['error'] = 'no function found'
        for case in work['cases'] if found else ():
            value = found[0](**{k: made(v, work['kinds'].get(k)) for k, v in case.items()})
            out['results'].append({'output': plain(value), 'type': type(value).__name__})
    except MemoryError:
        out['error'] = 'out of memory'
    except BaseException as e:
        out['error'] = type(e).__name__ + ': ' + str(e)[:300]
    outs.append(out)
sys.stdout.write('\n' + json.dumps(outs))
sys.stdout.flush()
os._exit(0)
"""

#: Calls of plain arithmetic that share a child.
SHARED = 50

#: What plain arithmetic consists of. Attributes and calls are looked at one by one.
ARITHMETIC = (
    ast.Module, ast.FunctionDef, ast.arguments, ast.arg, ast.Return, ast.Assign, ast.AugAssign, ast.If, ast.Pass, ast.Expr, ast.Constant, ast.Name, ast.Load, ast.Store,
    ast.BinOp, ast.UnaryOp, ast.BoolOp, ast.Compare, ast.IfExp, ast.Tuple, ast.Call, ast.Attribute, ast.operator, ast.unaryop, ast.boolop, ast.cmpop,
)
CALLED = {"abs", "min", "max", "float", "int", "bool", "round", "print"}


def plain_arithmetic(code: str) -> bool:
    """Whether code is functions without loops, names of the system or objects that outlive a call: only then can it change nothing for other code."""
    try:
        tree = ast.parse(code)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    if any(not isinstance(n, ast.FunctionDef) for n in tree.body):
        return False
    functions = 0
    for n in ast.walk(tree):
        if not isinstance(n, ARITHMETIC):
            return False
        if isinstance(n, ast.FunctionDef):
            functions += 1
            if n.decorator_list or getattr(n, "type_params", None) or n.name in CALLED or n.name in ("math", "cmath") or n.name.startswith("_"):
                return False
        elif isinstance(n, (ast.Name, ast.arg)):
            if (n.id if isinstance(n, ast.Name) else n.arg).startswith("_"):
                return False
        elif isinstance(n, ast.Call):
            by_name = isinstance(n.func, ast.Name) and n.func.id in CALLED
            if n.keywords or not (by_name or isinstance(n.func, ast.Attribute)):
                return False
        elif isinstance(n, ast.Attribute):
            if not (isinstance(n.value, ast.Name) and n.value.id in ("math", "cmath") and isinstance(n.ctx, ast.Load)) or n.attr.startswith("_"):
                return False
    return functions == len(tree.body)


#: Seconds beyond a call's own limit after which a server that says nothing is given up.
GRACE = 30.0


class Sandbox:
    """Runs candidate code until it is closed: ``with Sandbox() as box: box.run(code, cases)``. For one thread at a time."""

    def __init__(self) -> None:
        self.servers: dict[str, subprocess.Popen] = {}

    def __enter__(self) -> Sandbox:
        return self

    def __exit__(self, *_: object) -> None:
        for kind in list(self.servers):
            self.end(kind)

    def end(self, kind: str) -> int:
        """The exit code of a server, which is killed if it still runs."""
        server = self.servers.pop(kind)
        try:
            server.stdin.close()
        except OSError:
            pass
        try:
            server.wait(1)
        except subprocess.TimeoutExpired:
            server.kill()
        server.stdout.close()
        return server.wait()

    def asked(self, kind: str, limit: int, seconds: float, text: bytes) -> tuple[bytes, int, bytes]:
        """The status of a call: ended, timed out, failed to fork or lost with its server; with a code and its last line."""
        if kind not in self.servers:
            # numpy is imported only for code that names it: a smaller process forks faster and leaves more below the memory limit
            self.servers[kind] = subprocess.Popen([sys.executable, "-I", "-c", SERVER, kind], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, env={"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"}, bufsize=0)
        server = self.servers[kind]
        try:
            out = memoryview(struct.pack(">qdq", limit, seconds, len(text)) + text)
            while out:
                out = out[server.stdin.write(out) :]
            status, number, size = struct.unpack(">cqq", self.read(server, 17, seconds + GRACE))
            return status, number, self.read(server, size, GRACE)
        except (OSError, EOFError):
            return b"L", self.end(kind), b""

    @staticmethod
    def read(server: subprocess.Popen, size: int, seconds: float) -> bytes:
        ready, parts = select.poll(), []
        ready.register(server.stdout, select.POLLIN | select.POLLHUP)
        while size:
            if not ready.poll(seconds * 1000):
                raise EOFError("the server says nothing")
            part = server.stdout.read(min(size, 1 << 20))
            if not part:
                raise EOFError("the server ended")
            parts.append(part)
            size -= len(part)
        return b"".join(parts)

    def run(self, code: str | None, cases: list[dict], seconds: float = 10.0, memory_mb: int = 1024, kinds: dict[str, str] | None = None) -> dict:
        """{"error", "results": [{"output", "type"}]}: the first function of the code on each case; the first failure ends it.

        ``kinds`` (argument -> type) makes what JSON cannot hold: complex numbers, tuples, arrays.
        """
        return self.run_all([(code, cases, kinds or {})], seconds, memory_mb)[0]

    def run_all(self, calls: list[tuple[str | None, list[dict], dict[str, str]]], seconds: float = 10.0, memory_mb: int = 1024) -> list[dict]:
        """What ``run`` gives for each (code, cases, kinds), in their order."""
        out: list[dict | None] = [None if code and code.strip() else {"error": "no code found", "results": []} for code, _, _ in calls]
        safe: dict[str, bool] = {}
        shared = []
        for k, (code, _, kinds) in enumerate(calls if len(calls) > 1 else ()):
            if out[k] is None and server_for(code, kinds) == "plain":
                if code not in safe:
                    safe[code] = plain_arithmetic(code)
                if safe[code]:
                    shared.append(k)
        for a in range(0, len(shared), SHARED):
            some = shared[a : a + SHARED]
            status, _, line = self.asked("plain", memory_mb << 20, seconds, request([calls[k] for k in some]))
            try:
                got = json.loads(line) if status == b"E" else []
            except ValueError:
                got = []
            for k, result in zip(some, got if len(got) == len(some) else ()):
                # what depends on how much others took is found out alone
                if not (result["error"] or "").startswith(("out of memory", "RecursionError", "MemoryError")):
                    out[k] = result
        return [self.alone(call, seconds, memory_mb) if result is None else result for call, result in zip(calls, out)]

    def alone(self, call: tuple[str, list[dict], dict[str, str]], seconds: float, memory_mb: int) -> dict:
        ask = server_for(call[0], call[2]), memory_mb << 20, seconds, request([call])
        status, number, line = self.asked(*ask)
        if status == b"L":
            # what another call left behind may have ended the server: this one is run again, on a new one
            status, number, line = self.asked(*ask)
        if status == b"F":
            raise OSError(number, "no child process for candidate code")
        if status == b"T":
            return {"error": "timed out", "results": []}
        try:
            return json.loads(line)[0]
        except ValueError:
            return {"error": f"ended with code {number}", "results": []}


def server_for(code: str, kinds: dict[str, str]) -> str:
    return "numpy" if "np" in code or "numpy" in code or {"ndarray", "array"} & set(kinds.values()) else "plain"


def request(calls: list[tuple[str, list[dict], dict[str, str]]]) -> bytes:
    return json.dumps([{"code": code, "cases": cases, "kinds": kinds} for code, cases, kinds in calls]).encode()


def run(code: str | None, cases: list[dict], seconds: float = 10.0, memory_mb: int = 1024, kinds: dict[str, str] | None = None) -> dict:
    """One call in a sandbox of its own."""
    with Sandbox() as box:
        return box.run(code, cases, seconds, memory_mb, kinds)
