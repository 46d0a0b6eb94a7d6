"""Command expansion, composed flows and the registered queries."""
