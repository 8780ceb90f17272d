"""Row-wise transformations for ``DataFrame.transform``; no shuffles."""
