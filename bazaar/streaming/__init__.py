"""Streaming: the reference analysis is batch-only (no watermark, window,
state or late data anywhere), so nothing is built here.  Every KPI in
``bazaar.operators.metrics`` is a plain ``groupBy`` over a time bucket and
would run unchanged on a ``readStream`` source with a watermark if a live
feed were ever needed."""
