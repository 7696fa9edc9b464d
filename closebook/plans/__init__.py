"""The close itself: balances, runs, movements and ledger checks."""
