"""Steps from frame to frame."""
