"""Training-data operators (packing, quality, HTML, licenses, shards, ANN, token files, near copies, secrets, BPE)."""
