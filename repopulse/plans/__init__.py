"""The tables and reports a user asks for, composed from the operators."""
