"""Writers; each takes a batch or a streaming DataFrame where that makes sense."""
