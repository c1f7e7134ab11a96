"""Streaming: intentionally empty.

The original tool is a finite batch run over whole files (a manifest loop);
it has no watermark, window, state or late data. Every operator here is a
batch DataFrame plan. The stateless ones (barcode assignment, alignment
blocks, the overlap join against a broadcast annotation) would run unchanged
on a ``readStream`` source; the anti-join and the counts need whole-sample
input and are not offered as streams.
"""
