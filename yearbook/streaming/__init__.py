"""The raw part of the build as a stream."""
