"""One module per layer table or analytical product."""
