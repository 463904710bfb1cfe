"""Tables, feeds and dimensions."""
