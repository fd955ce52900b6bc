"""Drop-folder intake as a stream."""
