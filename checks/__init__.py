"""Every operator run on the shared test tables, with an independent SQL text beside it."""
