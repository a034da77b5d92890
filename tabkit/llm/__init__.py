"""Operators of a large-scale training-data pipeline, as Spark jobs.

One module per operator, each with its own general interface:

* ``fingerprints`` -- homomorphic multiset fingerprints of documents
* ``shards``       -- fixed virtual slots and a versioned slot map
* ``bpe``          -- byte-level BPE encoding and decoding
* ``packing``      -- best-fit-decreasing packing of token ids
* ``token_counts`` -- count-only unigram Viterbi
* ``near_dups``    -- MinHash near duplicates through an LSH forest
* ``url_lists``    -- temporal URL lists joined as of the fetch time
* ``mixing``       -- systematic sampling towards target weights
* ``warc``         -- deterministic sharded WARC writer and reader
* ``quality``      -- weak supervision over quality rules
* ``resampling``   -- importance resampling towards target texts
* ``lm``           -- log-bilinear language model, trained and applied
* ``alignment``    -- two tokenizers aligned over the same bytes

``queries`` registers one thin query per operator and the pipeline.  Nothing
else in the library imports this subpackage.
"""
