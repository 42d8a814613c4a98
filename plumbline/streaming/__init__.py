"""The stateless operators over a stream, and a windowed pass rate."""
