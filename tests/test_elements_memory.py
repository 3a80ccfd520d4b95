import tracemalloc

import pyarrow as pa

from orgmill.operators import blocks


def test_elements_of_a_batch_are_whole_numbers_not_objects():
    page = "<ul>" + "<li><b>x</b>é<br>" * 200 + "</ul>"
    html = pa.array([page, None, "", "<p>a"] * 200)
    tracemalloc.start()
    found = blocks.elements.func(html)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist()[:4] == [blocks.scanned(page), [], [], blocks.scanned("<p>a")]
    assert len(found.flatten()) > 120_000 and peak < 40 * len(found.flatten())  # some 500 bytes an element as objects
