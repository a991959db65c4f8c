"""Record ends of CSV bytes, block by block, by the parity of quotes."""

from __future__ import annotations

import codecs

import numpy as np

QUOTE, COMMA, LF, CR = 0x22, 0x2C, 0x0A, 0x0D
MARK = codecs.BOM_UTF8


class Scanner:
    """Finds where records end in a stream of blocks, as offsets after their line ends; a mark at the start belongs to the first record.

    A line end counts where the number of quotes before it is even: CRLF, LF or CR.  A quote inside a field that is not quoted opens nothing, so blocks with such quotes
    are looked at quote by quote.  ``broken``: where the first field goes on after its closing quote, or UTF-8 fails; nothing after it can be trusted.
    """

    def __init__(self):
        self.at, self.inside, self.last, self.broken = 0, False, LF, None
        self.pending_cr = self.closed = False
        self.start: bytes | None = b""
        self.text = codecs.getincrementaldecoder("utf-8")()

    def feed(self, block: bytes) -> np.ndarray:
        if self.start is not None:
            # A mark may be cut in two.
            block, self.start = self.start + block, None
            if len(block) < len(MARK) and MARK.startswith(block):
                self.start, block = block, b""
        return self._feed(block) if block else np.zeros(0, np.int64)

    def _feed(self, block: bytes) -> np.ndarray:
        raw = np.frombuffer(block, np.uint8)
        if self.at == 0 and block.startswith(MARK):
            raw = raw.copy()
            # The mark stands for a line end before it: a quote right after it opens a field.
            raw[:3] = COMMA
        before = np.concatenate(([self.last], raw[:-1]))
        quotes = np.flatnonzero(raw == QUOTE)
        opens = np.isin(before[quotes], (COMMA, LF, CR, QUOTE))
        parity = (np.arange(len(quotes)) + self.inside) % 2 == 1
        if (~parity & ~opens).any() or (len(quotes) and before[quotes[0]] == QUOTE and not self.inside and not self.closed):
            quotes = self._plain(quotes, before)
        marks = np.zeros(len(raw), np.int64)
        marks[quotes] = 1
        inside = (np.cumsum(marks) + self.inside) % 2 == 1
        follows = ~inside & (before == QUOTE) & np.isin(np.arange(len(raw)) - 1, np.append(quotes, -1 if self.closed else -2))
        bad = np.flatnonzero(follows & ~np.isin(raw, (COMMA, LF, CR, QUOTE)))
        if len(bad) and self.broken is None:
            self.broken = self.at + int(bad[0])
        try:
            self.text.decode(block)
        except UnicodeDecodeError as e:
            self.broken = min(self.at + e.start, self.broken if self.broken is not None else self.at + e.start)
            self.text.reset()
        lf, cr = (raw == LF) & ~inside, (raw == CR) & ~inside
        paired = np.append(raw[1:] == LF, False)
        ends = np.flatnonzero(lf | (cr & ~paired)) + 1
        if cr[-1]:
            # Whether a line feed follows is not known yet.
            ends = ends[:-1]
        if self.pending_cr and raw[0] != LF:
            ends = np.concatenate(([0], ends))
        self.pending_cr, ends = bool(cr[-1]), ends + self.at
        self.inside, self.last = bool(inside[-1]), int(raw[-1])
        self.closed = bool(len(quotes) and quotes[-1] == len(raw) - 1 and not self.inside)
        self.at += len(raw)
        return ends

    def _plain(self, quotes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The quotes of a block that open, close or escape."""
        out, inside, last = [], self.inside, -1 if self.closed else -2
        for q in quotes.tolist():
            if inside or before[q] in (COMMA, LF, CR) or (before[q] == QUOTE and last == q - 1):
                out.append(q)
                inside, last = not inside, q
        return np.array(out, np.int64)

    def finish(self) -> np.ndarray:
        """The end of the last record where the stream ends, if it has no line end; a field that is still open is broken there."""
        if self.start:
            short, self.start = self.start, None
            self._feed(short)
        if self.inside and self.broken is None:
            self.broken = self.at - 1
        return np.array([self.at] if self.at and (self.pending_cr or self.last not in (LF, CR) or self.inside) else [], np.int64)


def split_records(raw: bytes) -> list[bytes]:
    """The raw records of a CSV file with their line ends: quotes are respected, CRLF, LF and CR end a record, a mark stays."""
    scan = Scanner()
    ends = np.concatenate((scan.feed(raw), scan.finish())).tolist()
    if scan.inside:
        raise ValueError("unterminated quote")
    return [raw[a:b] for a, b in zip([0, *ends], ends)]
