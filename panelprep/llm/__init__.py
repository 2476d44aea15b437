"""Training-data operators: each works on a whole table and has its query in :mod:`panelprep.llm.queries`."""
