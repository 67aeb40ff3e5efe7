"""The first record of a file, against a reader that goes byte by byte."""

import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.sources import heads

CELLS = st.lists(st.text(st.sampled_from(list('ab ",\n5é')), max_size=6), min_size=2, max_size=5)


class Pieces(io.BytesIO):
    def read(self, n=-1):
        return super().read(3 if n > 3 else n)


@settings(max_examples=300, deadline=None)
@given(CELLS, st.booleans(), st.booleans())
def test_headers_in_quotes(cells, mark, small):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(cells)
    data = (b"\xef\xbb\xbf" if mark else b"") + out.getvalue().encode()
    stream = (Pieces if small else io.BytesIO)(data + b'1,"2\n3",4\n')
    assert heads.first_record(stream) == data


def test_a_quote_inside_a_cell_is_text():
    rows = b"1,2\n" * 100_000
    for header in (b'Size 5",Name\n', b'a""b,c\n', b'"a"b",c\n', b'x,"y"z,"w"\n', b'Inch ",",q"\n'):
        assert heads.first_record(io.BytesIO(header + rows)) == header


def test_line_breaks_in_a_quoted_cell():
    assert heads.first_record(io.BytesIO(b'a,"b\nc ""d"" \n",e\n1,2,3\n')) == b'a,"b\nc ""d"" \n",e\n'
    assert heads.first_record(io.BytesIO(b"")) == b"" and heads.first_record(io.BytesIO(b"a,b")) == b"a,b"
