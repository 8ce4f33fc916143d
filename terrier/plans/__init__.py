"""The batch pipeline: extract, clean, preprocess, train, evaluate, predict."""
