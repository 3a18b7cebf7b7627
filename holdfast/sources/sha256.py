"""SHA-256 whose state can be kept and gone on from: hashlib's objects can not leave their process."""

from __future__ import annotations

import ctypes
import ctypes.util
from functools import cache


class _Context(ctypes.Structure):
    """SHA256_CTX of OpenSSL: chaining values, bits so far, and the bytes of a block begun."""

    _fields_ = [
        ("h", ctypes.c_uint32 * 8),
        ("low", ctypes.c_uint32),
        ("high", ctypes.c_uint32),
        ("data", ctypes.c_uint32 * 16),
        ("num", ctypes.c_uint32),
        ("md_len", ctypes.c_uint32),
    ]


@cache
def _library() -> ctypes.CDLL:
    """The OpenSSL that hashlib itself uses, else the system's."""
    names = [ctypes.util.find_library("crypto")]
    try:
        import _hashlib

        names.insert(0, _hashlib.__file__)
    except ImportError:
        pass
    for name in filter(None, names):
        library = ctypes.CDLL(name)
        if hasattr(library, "SHA256_Update"):
            library.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_void_p, ctypes.c_size_t]
            library.SHA256_Init.argtypes = [ctypes.c_void_p]
            library.SHA256_Final.argtypes = [ctypes.c_void_p, ctypes.c_void_p]
            return library
    raise RuntimeError("no OpenSSL with SHA256_Update on this machine: files in several parts need it")


class Sha256:
    """A digest that goes on from a kept state, or begins."""

    def __init__(self, state: bytes | None = None) -> None:
        self._context = _Context()
        if state is None:
            _library().SHA256_Init(ctypes.byref(self._context))
        else:
            self._context = _Context.from_buffer_copy(state)

    @property
    def n_bytes(self) -> int:
        return (self._context.high << 32 | self._context.low) // 8

    @property
    def state(self) -> bytes:
        return bytes(self._context)

    def update(self, address: int, size: int) -> None:
        """Go on over bytes in memory."""
        _library().SHA256_Update(ctypes.byref(self._context), address, size)

    def hexdigest(self) -> str:
        """Of the bytes so far; more may follow."""
        out = ctypes.create_string_buffer(32)
        _library().SHA256_Final(out, ctypes.byref(_Context.from_buffer_copy(self.state)))
        return out.raw.hex()
