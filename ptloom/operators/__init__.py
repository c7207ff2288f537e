"""DataFrame → DataFrame operators (build, chat, validate, classify, evaluate,
split, tokens, runs, align)."""
