"""Training-data operators: mixing, search, near copies, secrets, language, licences, toxicity,
benchmark leaks, page text and repeated passages.  Nothing outside this subpackage imports it."""
