"""DataFrame operators of the layered model and of the analytics on its roll-ups."""
