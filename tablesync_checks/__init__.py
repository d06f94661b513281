"""The registered queries: every operator over whole tables, each with its SQL counterpart."""
