"""The queries of the core, by name, and their SQL."""

from textmill.plans import corpus, devices, extras, files, lexicon, pairs, speech, streams

MODULES = (lexicon, corpus, pairs, speech, devices, extras, streams, files)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
